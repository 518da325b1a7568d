"""Collocations and spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from legweave.llm import collocations, segments, spelling
from legweave.llm.batches import utf8

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Collocations


def phrases_by_hand(rows, most, least, cover):
    """Rows (lang, text) to the leading phrases, every phrase counted and every longer one looked at."""
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(A_TO_Z)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for longer, a in candidates.items():
            for k in range(2, len(longer)):
                for i in range(len(longer) - k + 1):
                    inner = longer[i : i + k]
                    if 100 * a >= cover * f[inner]:
                        covered.add(inner)
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def prose(rng, words, n):
    """Words of which some like to follow each other, with marks and odd blanks between."""
    out, last = [], 0
    for _ in range(n):
        last = (last * 7 + 1) % len(words) if rng.random() < 0.6 else int(rng.triangular(0, len(words), 0))
        out.append(words[last].upper() if rng.random() < 0.1 else words[last])
        out.append(rng.choice([" "] * 12 + ["\t", "  ", ". ", ", ", "\n", "; ", "!", "\x0b", " \r\n"]))
    return "".join(out)


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(8)
    words = ["the", "of", "new", "york", "été", "É", "x", "\U0001F600", "it's", "-", "Haus", "a b"[0], "ñandú"]
    rows = [(rng.choice(["en", "en", "en", "de", None, "und"]), prose(rng, words, rng.randint(0, 60))) for _ in range(120)]
    return rows + [("en", None), ("en", ""), (None, None), ("fr", " \t.\n"), ("fr", "one two three"), rows[0], rows[0]]


@pytest.mark.parametrize(("most", "least", "cover", "margin"), [(2_000, 3, 80, 2), (7, 3, 60, 1), (3, 5, 30, 1), (1, 2, 80, 1)])
def test_collocations(spark, spoken, monkeypatch, most, least, cover, margin):
    """With few wanted phrases the frontier stops early, or grows in several rounds."""
    monkeypatch.setattr(collocations, "MARGIN", margin)
    docs = spark.createDataFrame([(*r, 1, 2) for r in spoken], "lang string, text string, f long, phrase int")
    got = collocations.mine_collocations(docs.repartition(3), most, least, cover)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(spoken, most, least, cover)


def test_the_frontier_falls_until_enough_survive(spark):
    """The best pairs are all covered by longer phrases, so the first level settles nothing."""
    rows = [("en", f"a{i} b{i} c{i} d{i}.") for i in range(40) for _ in range(4)]
    rows += [("en", f"common w{i}; w{i}") for i in range(30) for _ in range(3)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.mine_collocations(docs, 60, 3, 80)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand(rows, 60, 3, 80)


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(8 * 10**18, 9 * 10**18, 9 * 10**18)], "a long, l long, r long")
    got = rows.select(collocations._score(collocations.F.col("a"), collocations.F.col("l"), collocations.F.col("r")).alias("s"))
    assert got.collect()[0].s == 2_000_000 * 8 // 18


def test_texts_are_counted_in_parts(spark):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "a", "b" * 300]
    rows = [("en", prose(rng, words, 400)), ("en", " ".join(rng.choice(words) for _ in range(500))), ("de", "z" * 900)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    for size in (1, 2, 3, 4):
        whole = collocations.count_phrases(docs, size)
        parts = collocations.count_phrases(docs, size, limit=64)
        assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, parts.collect()))


def test_equal_hashes_are_told_apart():
    data = np.frombuffer(b"ab cd ab ce cde ", np.uint8)
    spans, sizes = np.array([0, 3, 6, 9, 12]), np.array([2, 2, 2, 2, 3])
    first, counts = collocations._grouped(np.zeros(5, np.uint64), spans, sizes, data)
    assert first.tolist() == [0, 1, 3, 4] and counts.tolist() == [2, 1, 1, 1]


def test_no_collocations(spark, no_docs, odd_docs, odd_rows):
    assert collocations.mine_collocations(no_docs).collect() == []
    got = collocations.mine_collocations(odd_docs, 50, 4, 80)
    assert sorted(map(tuple, got.collect())) == phrases_by_hand([(r[2], r[1]) for r in odd_rows], 50, 4, 80)


def test_segments_cover_every_byte():
    import pyarrow as pa

    data, starts = utf8(pa.array(["a b.c", "", "word " * 50, "x" * 95, "k. " * 40]))
    dot, blank = segments.byte_set("."), segments.byte_set(" ")
    seen = defaultdict(bytes)
    for part, at, row in segments.segments(data, starts, (dot, blank), lambda part, kind: 0, 20):
        for i in range(len(at) - 1):
            seen[row + i] += part[at[i] : at[i + 1]].tobytes()
    assert [seen[i] for i in range(5)] == [data[a:b].tobytes() for a, b in zip(starts, starts[1:])]
    cut = [len(part) for part, _, row in segments.segments(data, starts, (dot, blank), lambda part, kind: 0, 20, 30) if row == 3]
    assert max(cut) == 30 and sum(cut) == 95


# Spelling variants


def worn_by_hand(rows, least=5):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= least
    return out


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1 :]
        if i < len(word):
            yield word[:i] + word[i + 1 :]


def variants_by_hand(counts, least=3):
    n = {w: k for w, k in counts.items() if k >= least}
    letters = sorted({c for w in n for c in w})
    near = {w: {v for v in edits(w, letters) if v in n and v != w} for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v), default=None) for w in n}
    form = {w: v if v is not None and n[v] >= 2 * n[w] else None for w, v in form.items()}
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return Counter(out)


@pytest.fixture(scope="module")
def misspelt():
    """Words and their variants with one to four signs changed, so that chains, ties and repeated signs occur."""
    rng = random.Random(9)
    stems = ["aaaaa", "letter", "mississippi", "überÄußerst", "ÿÀ÷×xyz", "banana", "abcdefgh" * 12]
    rows = []
    for i in range(900):
        word = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1 :], word[:at] + rng.choice("abs") + word[at:], word[:at] + "a" + word[at + 1 :]])
        rows.append((i % 300 if i % 50 else None, f"{word.upper() if i % 9 == 0 else word}, {word}×x {word}1 {word}\U0001F600"))
    return rows + [(1, None), (2, ""), (None, None), rows[0], rows[3]]


def test_spelling_variants(spark, misspelt):
    docs = spark.createDataFrame([(*r, "w", 3) for r in misspelt], "doc_id long, text string, word string, n int")
    got = spelling.spelling_variants(docs.repartition(3))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = variants_by_hand(worn_by_hand(misspelt))
    assert Counter(map(tuple, got.collect())) == want
    assert any(r[1] and r[1] != r[2] for r in want)  # chains of forms


def test_spelling_with_short_ranges(spark, misspelt, monkeypatch):
    """With hashed rotations the answer is the same."""
    monkeypatch.setattr(spelling, "PLAIN", 3)
    docs = spark.createDataFrame(misspelt, "doc_id long, text string")
    got = spelling.spelling_variants(docs)
    assert Counter(map(tuple, got.collect())) == variants_by_hand(worn_by_hand(misspelt))


def test_spelling_on_the_documents(spark):
    from legweave.llm.queries import REGISTRY

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = variants_by_hand(worn_by_hand(docs.select("doc_id", "text").collect()))
    got = REGISTRY["op13_spelling_variants"].run(spark, "/root/testdata/sf0.001")
    assert Counter(map(tuple, got.collect())) == want


def test_spelling_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = spelling.spelling_variants(odd_docs)
    assert Counter(map(tuple, got.collect())) == variants_by_hand(worn_by_hand([r[:2] for r in odd_rows]))
    assert spelling.spelling_variants(no_docs).collect() == []
    long = spark.createDataFrame([(i, "b" * 3_000 + "c" * (i % 3)) for i in range(12)], "doc_id long, text string")
    rows = spelling.spelling_variants(long).collect()
    assert Counter(map(tuple, rows)) == variants_by_hand(worn_by_hand(long.collect()))
    with pytest.raises(ValueError, match="times"):
        spelling.spelling_variants(no_docs, times=1)
