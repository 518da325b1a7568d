"""Embedding, substring and shingle operators against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from legweave.llm import components, embeddings, jaccard, ordered, substrings

# Helpers


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)] + [(5, 5), (9, 7), (7, 8), (7, 9)]
    random.Random(1).shuffle(links)
    got = dict(map(tuple, components.components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()))
    want = {i: 100 for i in range(100, 141)} | {i: 200 for i in range(200, 260)} | {7: 7, 8: 7, 9: 7}
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_running_totals(spark):
    rows = [(i % 7, i, float(i % 3)) for i in range(500)] + [(None, 3, 1.0)]
    got = ordered.running_totals(spark.createDataFrame(rows, "k int, n long, w double").repartition(5), ["k", "n"], ["n", "w"])
    total, weight = 0, 0.0
    for r in sorted(got.collect(), key=lambda r: (r.k is not None, r.k or 0, r.n)):
        assert (r.before_n, r.before_w) == (total, pytest.approx(weight))
        total, weight = total + r.n, weight + r.w


# Embeddings


def links_by_hand(rows, threshold):
    vectors = {}
    for n, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or label is None or not vector or any(c is None or not np.isfinite(c) for c in vector):
            continue
        if any(vector):
            vectors[n] = (np.array(vector, float) / np.linalg.norm(np.array(vector, float)), label)
    links = defaultdict(set)
    for a, (x, la) in vectors.items():
        for b, (y, lb) in vectors.items():
            if a < b and la == lb and len(x) == len(y) and x @ y >= threshold:
                links[a].add(b)
                links[b].add(a)
    out = []
    for n, (vec_id, *_) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        low = min(rows[m][0] for m in seen) if vec_id is not None else None
        out.append((vec_id, len(links[n]), low, vec_id == low))
    return Counter(out)


@pytest.mark.parametrize("small", [False, True])
def test_near_embeddings(spark, monkeypatch, small):
    """With small cells every label has pivots, and tiles split."""
    if small:
        monkeypatch.setattr(embeddings, "PER_PIVOT", 12)
        monkeypatch.setattr(embeddings, "TILE", 7)
        monkeypatch.setattr(embeddings, "STEP", 16)
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(6, 8))
    for i in range(260):
        v = centres[i % 6] * rng.uniform(0.5, 3) + rng.normal(size=8) * rng.choice([0.01, 0.15, 2.0])
        rows.append((i, v.astype(np.float32).tolist(), [0, 0, 0, 1, None][i % 5] if i % 3 else 0))
    rows += [(300 + i, rows[4][1], rows[4][2]) for i in range(20)] + [rows[0], rows[0]]
    rows += [
        (400, None, 0), (401, [], 0), (402, [0.0] * 8, 0), (403, [float("nan")] * 8, 0), (404, [float("inf")] + [1.0] * 7, 0),
        (405, [None] + [1.0] * 7, 0), (406, [1.0, 2.0], 0), (407, [2.0, 4.0], 0), (None, rows[0][1], 0), (408, [1e-30] * 8, 1),
        (409, [1e30] * 8, 1), (410, [-0.0] * 8, 1),
    ]
    # Ids that come again with another vector, near their own or not, and with another label.
    rows += [(i, (np.array(rows[i][1]) * 2 + 0.01).tolist(), rows[i][2]) for i in range(0, 30)]
    rows += [(i, rows[i + 40][1], rows[i + 40][2]) for i in range(30)] + [(i, rows[i][1], 2) for i in range(20)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, cell int")
    got = embeddings.near_embeddings(table.repartition(3), 0.98).collect()
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], k) for i, v, k in rows]
    assert Counter(map(tuple, got)) == links_by_hand(rows, 0.98)


def test_an_id_of_several_vectors_and_labels(spark):
    rows = [(1, [1.0, 0.0], "a"), (1, [0.99, 0.1], "a"), (2, [0.0, 1.0], "b"), (2, [1.0, 0.0], "c"), (3, [0.0, 1.0], "b"), (4, [1.0, 0.0], "c")]
    got = embeddings.near_embeddings(spark.createDataFrame(rows, "vec_id int, embedding array<double>, label string"))
    assert Counter(map(tuple, got.collect())) == links_by_hand(rows, 0.98)
    assert sorted(r.n_links for r in got.collect()) == [1] * 6 and got.schema["component_id"].dataType.simpleString() == "int"


def test_pivots_fit_their_bound(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_PIVOT", 10)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), "ab"[i % 2]) for i in range(2_000)]
    classes = spark.createDataFrame(rows, "cid long, embedding array<double>, label string").selectExpr("*", "4 AS dim")
    assert {k: len(v) for k, v in embeddings._pivots(classes).items()} == {("a", 4): 16, ("b", 4): 16}
    monkeypatch.setattr(embeddings, "PIVOT_NUMBERS", 80)
    assert {k: len(v) for k, v in embeddings._pivots(classes).items()} == {("a", 4): 16, ("b", 4): 4}


def test_no_embeddings(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_embeddings(empty).collect() == []


# Substrings


def removed_by_hand(rows, length):
    """Per row of (order, text) the digest columns, windows counted in that order."""
    seen, out = {}, []
    for n, (key, text) in enumerate(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if seen.setdefault(data[i : i + length], (key, i)) != (key, i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((key[0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "limit", "part"), [(100, 8_192, 2_000_000), (100, 1, 70), (23, 2, 150)])
def test_repeated_substrings(spark, length, limit, part):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(500))
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            if kind < 0.5:
                at = rng.randint(0, 400)
                parts.append(passage[at : at + rng.randint(5, 200)])
            elif kind < 0.7:
                parts.append(rng.choice(["a", "ab", "abcé"]) * rng.randint(1, 150))
            else:
                parts.append("".join(rng.choice("xyzé\U0001F600") for _ in range(rng.randint(1, 120))))
        rows.append((d, "".join(parts) if d % 11 else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substrings.remove_repeats(docs, length, class_limit=limit, part_bytes=part).collect()
    assert sorted(map(tuple, got)) == sorted(removed_by_hand([((d,), t) for d, t in rows], length))


def test_repeated_substrings_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = substrings.remove_repeats(odd_docs, with_text=True).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows)
    for r in got:
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 or "�" in r.kept_text
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].n_removed == by_id[2].n_bytes > 0 and by_id[1].n_removed == 0
    # A null id comes first, and rows that repeat an id stand in the order of a hash of their text.
    texts = {(r[0], r[1] or "") for r in odd_rows}
    sums = {i: sum(len(t.encode()) for j, t in texts if j == i) for i, _ in texts}
    assert all(r.n_removed <= sums[r.doc_id] for r in got)
    assert substrings.remove_repeats(no_docs).collect() == []


def test_repeated_substrings_of_texts_that_share_ids(spark):
    """Ids that many texts share, null among them: the order is that of the id and then the text's hash."""
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(400))
    rows = set()
    for n in range(60):
        at = rng.randint(0, 250)
        text = f"{n} " + passage[at : at + rng.randint(50, 150)] + "z" * rng.randint(0, 3) + passage[:130] * (n % 2)
        rows.add((rng.choice([None, None, 7, 7, 8, -3, n]), text))
    rows |= {(7, ""), (None, None), (9, "short")}
    docs = spark.createDataFrame(sorted(rows, key=str), "doc_id long, text string").repartition(3)
    keyed = docs.selectExpr("doc_id", "text", "coalesce(doc_id, -9223372036854775808) AS d", "xxhash64(coalesce(text, '')) AS h")
    order = sorted(keyed.collect(), key=lambda r: (r.d, r.h))
    want = removed_by_hand([((r.doc_id, n), r.text) for n, r in enumerate(order)], 100)
    got = substrings.remove_repeats(docs.union(docs.limit(5)), 100).collect()
    assert Counter(map(tuple, got)).keys() == Counter(want).keys() and len(got) == len(want) + 5
    assert sum(w[2] for w in want) > 1_000


def test_merged_transforms_order_rotations():
    """The merged order is that of all rotations, and blocks are those alike in the compared prefix."""
    rng = random.Random(8)
    bodies = [bytes(rng.choice(b"ab") for _ in range(rng.randint(12, 40))) for _ in range(9)]
    length = 12
    data, seen, want = b"".join(bodies), {}, []
    at = 0
    for body in bodies:
        for i in range(len(body) - length + 1):
            if seen.setdefault(body[i : i + length], at + i) != at + i:
                want.append(at + i)
        at += len(body)
    assert substrings.later_windows(bodies, length).tolist() == want and len(data) == at


# Shingles


def ties_by_hand(rows, percent, size):
    sets = []
    for _, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if rows[a][0] is not None and rows[b][0] is not None and both:
                if 100 * both >= percent * len(sets[a] | sets[b]) or rows[a][0] == rows[b][0]:
                    root[max(find(a), find(b))] = min(find(a), find(b))
    low = defaultdict(list)
    for n, (doc_id, _) in enumerate(rows):
        low[find(n)].append(doc_id)
    return Counter((d, len(sets[n]), d if d is None else min(low[find(n)])) for n, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("percent", "size", "star", "part", "best"), [(80, 5, 64, 4_096, 2), (60, 3, 2, 15, 1), (90, 5, 8, 30, 1)])
def test_jaccard_components(spark, monkeypatch, percent, size, star, part, best):
    monkeypatch.setattr(jaccard, "STAR", star)
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "FIRST_BEST", best)
    monkeypatch.setattr(jaccard, "GROWTH", 2)
    monkeypatch.setattr(jaccard, "COMMON_FROM", 10)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for d in range(200):
        kind = rng.random()
        if kind < 0.6:
            some = list(base)
            for _ in range(rng.randint(0, 9)):
                some[rng.randrange(len(some))] = rng.choice(words)
            rows.append((d, " ".join(some).upper() if rng.random() < 0.3 else "\n".join(some)))
        elif kind < 0.8:
            rows.append((d, " ".join(rng.choices(words, k=rng.randint(0, 8)))))
        elif kind < 0.9 and rows:
            rows.append((d, rows[-1][1]))
        else:
            rows.append((d, rng.choice([None, "", " \n", "a b", "A  b", "a b c d e", "a b c d e " * 3])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_components(docs, percent, size).collect()
    assert Counter(map(tuple, got)) == ties_by_hand(rows, percent, size)


def test_no_group_of_a_large_tile_grows_with_it(spark, monkeypatch):
    """A tile of near copies and strangers of the same shingle: every group that is compared stays bounded."""
    for name, value in {"STAR": 8, "PART": 30, "FIRST_BEST": 1, "GROWTH": 4, "COMMON_FROM": 10}.items():
        monkeypatch.setattr(jaccard, name, value)
    inner = jaccard._tile

    def watched(*args, **more):
        run = inner(*args, **more)

        def checked(table):
            keys = [k for k in ("shingle", "part", "lo", "hi") if k in table.schema.names]
            most = max(table.group_by(keys).aggregate([("c", "count")])["c_count"].to_pylist())
            assert most <= 120, f"a group of {most} rows"
            return run(table)

        return checked

    monkeypatch.setattr(jaccard, "_tile", watched)
    rng = random.Random(8)
    base = [f"w{rng.randrange(300)}" for _ in range(90)]
    rows = []
    for d in range(260):
        some = list(base)
        for _ in range(rng.randint(1, 2) if d % 4 else rng.randint(4, 8)):
            some[rng.randrange(len(some))] = f"v{rng.randrange(900)}"
        rows.append((d, " ".join(some[: rng.randint(45, 90)] if d % 5 == 0 else some)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_components(docs, 80, 5).collect()
    assert Counter(map(tuple, got)) == ties_by_hand(rows, 80, 5)


def test_jaccard_of_odd_rows(odd_docs, odd_rows, no_docs):
    got = jaccard.jaccard_components(odd_docs).collect()
    want = ties_by_hand([r[:2] for r in odd_rows], 80, 5)
    assert Counter(map(tuple, got)) == want
    kept = jaccard.kept_documents(odd_docs)
    stays = {d for d, _, c in want if d == c}
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.collect()} == stays
    assert jaccard.jaccard_components(no_docs).collect() == []


def test_common_shingles_are_counted_over_batches(monkeypatch):
    """Batches of two documents report what one batch of all does, and long inputs are reported in parts."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    whole = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], ["id", "body"])
    sets = [frozenset(tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)) or {tuple(t.split())} for t in texts]
    want = sorted(n for n in Counter(x for s in sets for x in s if x).values() if n >= jaccard.SEEN_IN_BATCH)

    def reported(step):
        made = list(jaccard._profiles(5)(iter([whole.slice(at, step) for at in range(0, 60, step)])))
        rows = [r for b in made for r in b.to_pylist()]
        assert [r["id"] for r in rows if r["shingle"] is None] == list(range(60))
        return sorted((r["shingle"], r["n"]) for r in rows if r["shingle"] is not None)

    assert sorted(n for _, n in reported(60)) == want and want
    assert reported(2) == reported(60)
    monkeypatch.setattr(jaccard, "SEEN_ROWS", 20)
    parts = reported(2)
    assert len(parts) > len({s for s, _ in parts}) > 0


def test_signatures_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    import pyarrow as pa

    pool = rng.integers(1 << 63, size=6_000, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, size)) for size in (1, 5, 40, 300, 2_500, 2_600)]
    signatures = jaccard._Signatures(pa.chunked_array([pa.array([jaccard.signature(s) for s in sets], pa.binary())]))
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            apart = signatures.apart(np.array([i]), np.array([j]))[0]
            assert apart <= len(np.setxor1d(x, y)) and (apart == 0 or i != j)
