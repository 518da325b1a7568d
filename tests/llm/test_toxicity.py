"""The string kernel against plain Python, and its machine on planted and on held-out documents."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from legweave.llm import toxicity
from legweave.llm.queries import REGISTRY


def subsequences_by_hand(unit):
    """The weight of every subsequence of three signs of a unit, and the norm."""
    out, squares = defaultdict(float), 0.0
    for i, j, k in combinations(range(len(unit)), 3):
        signs = tuple(int(toxicity.SIGN[unit[x]]) for x in (i, j, k))
        if k - i < toxicity.SPAN and all(signs):
            weight = toxicity.DECAY ** (k - i + 1)
            out[signs] += weight
            squares += weight**2
    return out, squares**0.5


def units_by_hand(text):
    """Runs without white space; single signs one blank apart are one unit."""
    out, at = [], 0
    for token in text.replace("\t", " ").replace("\n", " ").split(" "):
        lone = len(token.encode()) == 1 and toxicity.SIGN[ord(token)] > 0
        if token:
            if lone and out and out[-1][2] and out[-1][1] == at - 1:
                out[-1] = (out[-1][0], at + 1, True)
            else:
                out.append((at, at + len(token.encode()), lone))
        at += len(token.encode()) + 1
    return [text.encode()[a:b] for a, b, _ in out]


TEXTS = ["idiot i-d-i-o-t i d i o t", "a bc déjà vu 1d10t", "x", "", "no\nyes\tmaybe  s o s", "ééé ñandú --- !?"]


def test_kernel():
    strings = [u for t in TEXTS for u in units_by_hand(t)]
    columns = toxicity.all_columns(strings)
    got = toxicity.features(strings, columns) @ toxicity.features(strings, columns).T
    for a, x in enumerate(strings):
        for b, y in enumerate(strings):
            (fx, nx), (fy, ny) = subsequences_by_hand(x), subsequences_by_hand(y)
            want = sum(w * fy.get(c, 0) for c, w in fx.items()) / (nx * ny) if nx and ny else 0
            assert got[a, b] == pytest.approx(want, abs=1e-5)


def test_margins_of_whole_texts(monkeypatch):
    rng = np.random.default_rng(3)
    machine = toxicity.StringKernelMachine(rng.normal(0, 0.3, toxicity.SIGNS**3).astype(np.float32), 0.05, np.ones(2))
    machine.weights[0] = 0
    pick = random.Random(4)
    texts = TEXTS + [" ".join(pick.choice(["the", "i d i o t", "moron,", "été", "b", "ab"]) for _ in range(90)) for _ in range(4)]
    data = "".join(texts).encode()
    starts = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    want = []
    for text in texts:
        found = [-toxicity.FAR, -toxicity.FAR]
        for unit in units_by_hand(text):
            weights, norm = subsequences_by_hand(unit)
            if norm:
                margin = sum(w * machine.weights[(a << 12) + (b << 6) + c] for (a, b, c), w in weights.items()) / norm + 0.05
                found.append(float(np.clip(margin, -toxicity.FAR, toxicity.FAR)))
        want.append(sorted(found, reverse=True)[:2])
    for size in (1_000_000, 150):
        monkeypatch.setattr(toxicity, "PART_BYTES", size)
        got = machine.margins(np.frombuffer(data, np.uint8), starts)
        if size == 150:  # two parts may both hold single signs that are cut between them
            assert got[:, 0] == pytest.approx(np.array(want)[:, 0], abs=1e-4)
        else:
            assert got == pytest.approx(np.array(want), abs=1e-4)


def test_long_runs_are_read_in_windows():
    machine = toxicity.train([b"idiot", b"idiot", b"other", b"words"], np.arange(4), np.array([True, True, False, False]), [b"idiot", b"words"])
    plain, hidden, clean = b"idiot", b"x" * 5_000 + b"idiot" + b"x" * 5_000, b"x" * 10_000
    data = np.frombuffer(plain + hidden + clean, np.uint8)
    starts = np.array([0, 5, 5 + len(hidden), len(data)])
    plain, hidden, clean = machine.margins(data, starts)[:, 0]
    assert plain > 0.5 and hidden > clean


def planted(n, seed):
    """Prose of invented words; a fifth insults, stretched and broken in half of those."""
    rng = random.Random(seed)
    parts = ["the", "an", "er", "ing", "ou", "on", "st", "re", "ha", "ble", "ly", "nd", "ti", "es"]
    insults = ["grobnik", "snaffler", "wurzelkopf"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        for _ in range(2 * toxic):
            word = rng.choice(insults)
            word = rng.choice([word, word.upper(), word + rng.choice(parts), "-".join(word), " ".join(word), word[:3] + "*" + word[3:]])
            words.insert(rng.randrange(len(words)), word)
        rows.append((i, " ".join(words) + rng.choice([".", "!", "\n"]), int(toxic)))
    return rows


def test_planted_insults_are_found_and_clean_documents_left_alone(spark):
    rows = planted(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows if zlib.crc32(str(r[0]).encode()) % 3], "doc_id long, toxic int")
    machine = toxicity.fit_toxicity(docs, labels)
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, machine).collect()}
    held = [r for r in rows if not zlib.crc32(str(r[0]).encode()) % 3]
    right = {k: np.mean([(found[r[0]] >= 0.5) == bool(k) for r in held if r[2] == k]) for k in (0, 1)}
    assert right[0] > 0.97 and right[1] > 0.9
    again = toxicity.fit_toxicity(docs.repartition(5), labels)
    assert (again.weights == machine.weights).all()


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    got = REGISTRY["op11_string_kernel"].run(spark, folder)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = {k: np.mean([r.predicted == k for r in rows if r.toxic == k]) for k in (0, 1)}
    assert right[0] > 0.97 and right[1] > 0.8  # one label in seven is set without an insult
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 1), (9, 0), (10, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    machine = toxicity.fit_toxicity(odd_docs, labels)
    rows = toxicity.score_toxicity(odd_docs, machine).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((d, t) for d, t, *_ in odd_rows)
    same = {}
    for r in rows:
        assert 0 <= r.score <= 1 and same.setdefault(r.text or "", r.score) == pytest.approx(r.score)
    bare = toxicity.fit_toxicity(no_docs, labels)
    assert toxicity.score_toxicity(no_docs, bare).collect() == []
    assert {r.score for r in toxicity.score_toxicity(odd_docs, bare).collect()} == {0.5}
