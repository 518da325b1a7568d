"""Language and quality models on held-out rows, and on odd tables."""

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from legweave.llm import language, quality, samples
from legweave.llm.queries import REGISTRY

SF = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    got = REGISTRY["op7_language_families"].run(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(truth, "doc_id").filter("held_out AND lang IS NOT NULL AND text RLIKE '[a-z]'").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_of_held_out_documents(spark):
    got = REGISTRY["op6_byte_network"].run(spark, SF)
    truth = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(truth, "doc_id").filter("held_out").collect()
    right = [np.mean([r.predicted == label for r in rows if r.quality == label]) for label in (0, 1)]
    assert min(right) > 0.7 and np.mean(right) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_languages_of_odd_rows(odd_docs, odd_rows, no_docs):
    model = language.fit_language_model(odd_docs)
    got = language.identify_languages(odd_docs, model)
    assert [c for c in got.columns if c not in ("lang_pred", "score")] == [c for c in odd_docs.columns if c != "score"]
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((d, t) for d, t, *_ in odd_rows)
    for r in rows:
        bare = not any(ch.isalpha() for ch in r.text or "")
        assert (r.lang_pred == "und") == bare and (not bare or r.score == 0)
    empty = language.fit_language_model(no_docs)
    assert language.identify_languages(no_docs, empty).collect() == []
    assert {r.lang_pred for r in language.identify_languages(odd_docs, empty).collect()} == {"und"}


def test_families_come_first():
    x = np.eye(5, language.BUCKETS, dtype=np.float32).repeat(4, axis=0)
    langs = np.array(["en", "de", "fr", "es", "xx"], object).repeat(4)
    model = language.LanguageModel.fit(x, langs)
    assert sorted(map(tuple, model.families)) == [("de", "en"), ("es", "fr"), ("xx",)]
    assert set(model.pair_weights) == {("de", "en"), ("es", "fr")}
    names, scores = model.predict(x)
    assert names.tolist() == langs.tolist() and ((scores >= 0) & (scores <= 1)).all()


def test_quality_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(1, 1), (7, 0), (7, 1), (9, 0), (10, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit_quality(odd_docs, labels)
    rows = quality.score_quality(odd_docs, model).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((d, t) for d, t, *_ in odd_rows)
    same = {}
    for r in rows:
        assert 0 <= r.score <= 1 and same.setdefault(r.text or "", r.score) == pytest.approx(r.score)
    bare = quality.fit_quality(no_docs, labels)
    assert quality.score_quality(no_docs, bare).collect() == []


def test_pooling_covers_the_whole_document():
    """A sign that one filter answers to is found wherever it stands, and never in a neighbour."""
    net = quality.train(np.empty((0, 0), np.uint8), np.empty(0, np.float32))
    net.filters[:] = 0
    net.filters[0, ord("!"), 0] = 3
    net.filters[1:, ord("a"), 1] = 1
    for length in (1, 255, 256, 257, 511, 512, 513, 2_000):
        for at in {0, length // 2, length - 1}:
            text = np.full(length, 97, np.uint8)
            text[at] = ord("!")
            data = np.concatenate([np.full(300, 97, np.uint8), text, np.full(300, 97, np.uint8)])
            starts = np.array([0, 300, 300 + length, 600 + length])
            pooled, owner = net.pooled(data, starts)
            top = [pooled[owner == d, 0].max() for d in range(3)]
            assert top == [0, 3, 0]
            empty, owner = net.pooled(data[:300], np.array([0, 300, 300]))
            assert (empty[owner == 1] == 0).all()
            lone, owner = net.pooled(data[:300], np.array([0, 0, 300]))
            assert (lone[owner == 0] == 0).all() and lone[owner == 1, 1].max() == quality.WIDTH - 1


def score_by_hand(net, text):
    """The network's probability, one byte, filter and chunk at a time."""
    lone = list(text) + [0] * quality.WIDTH
    places = max(len(text), 1)
    answers = [
        [sum(float(net.filters[k, lone[p + k], f]) for k in range(quality.WIDTH)) + float(net.bias[f]) for p in range(places)]
        for f in range(quality.FILTERS)
    ]
    begins = list(range(0, max(places - quality.STRIDE, 1), quality.STRIDE))
    logits = []
    for a in begins:
        pooled = [max(0.0, *row[a : a + 2 * quality.STRIDE], -1e9) for row in answers]
        logits.append(sum(x * float(w) for x, w in zip(pooled, net.out, strict=True)) + net.shift)
    return 1 / (1 + math.exp(-sum(logits) / len(logits)))


def test_quality_scores_by_hand(spark, monkeypatch):
    """Whole texts of all lengths around the strides, in one block and in parts of a few strides."""
    net = quality.train(np.empty((0, 0), np.uint8), np.empty(0, np.float32))
    rng = random.Random(3)
    sizes = [0, 1, 4, 5, 255, 256, 257, 300, 511, 512, 513, 700, 768, 769, 1_500, 3_000]
    texts = ["".join(rng.choice("abc é.\n漢") for _ in range(n)) for n in sizes] + [None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for places in (quality.PART_PLACES, 1, 600):
        monkeypatch.setattr(quality, "PART_PLACES", places)
        data = [(t or "").encode() for t in texts]
        starts = np.append(0, np.cumsum([len(d) for d in data]))
        got = net.score(np.frombuffer(b"".join(data), np.uint8), starts)
        assert got == pytest.approx([score_by_hand(net, d) for d in data], abs=1e-5)
    scored = {r.doc_id: r.score for r in quality.score_quality(docs, net).collect()}
    assert [scored[n] for n in range(len(texts))] == pytest.approx(got.tolist(), abs=1e-6)


def test_a_long_text_is_scored_in_bounded_memory():
    """24 MB in one text: what is held at a time stays below a few bytes per byte."""
    net = quality.train(np.empty((0, 0), np.uint8), np.empty(0, np.float32))
    data = np.random.default_rng(1).integers(32, 127, 24_000_000, dtype=np.uint8)
    tracemalloc.start()
    score = net.score(data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 <= score[0] <= 1 and peak < 3 * len(data)


def test_bounds_of_the_fits(spark):
    """The documented bounds are arguments, and no language is left out however many there are."""
    rows = [(n, f"wort{n % 7} " * 30, f"l{n % 9}", n % 2) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    model = language.fit_language_model(docs, per_language=2, most_documents=4)
    assert sorted(x for family in model.families for x in family) == [f"l{n}" for n in range(9)]
    data = np.frombuffer(b"x" * 5_000, np.uint8)
    assert [len(quality.spread_chunks(data, np.array([0, 5_000]), most)[0]) for most in (1, 3, 100)] == [1, 3, 9]
    net = quality.fit_quality(docs, docs.select("doc_id", "quality"), per_label=3, chunks=1)
    assert net.filters.shape == (quality.WIDTH, 256, quality.FILTERS)


def language_by_hand(model, text):
    """The language and score of one text in plain Python, from the model's weights."""
    low = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    counts = Counter(
        ((sum(b * m for b, m in zip(low[i : i + 3], (40503, 30011, 10007), strict=True)) * 2654435761) % (1 << 32)) >> 20
        for i in range(len(low) - 2)
    )
    profile = {bucket: math.sqrt(n / sum(counts.values())) for bucket, n in counts.items()}

    def heat(w):
        margin = sum(x * float(w[bucket]) for bucket, x in profile.items()) + float(w[-1])
        return 1 / (1 + math.exp(-language.SHARPNESS * margin))

    heats = [heat(w) for w in model.family_weights]
    best = heats.index(max(heats))
    family = model.families[best]
    votes = {lang: 0.0 for lang in family}
    for (a, b), w in model.pair_weights.items():
        if a in votes:
            votes[a] += heat(w)
            votes[b] += 1 - heat(w)
    pick = max(family, key=votes.get)
    within = votes[pick] / (len(family) - 1) if len(family) > 1 else 1.0
    return pick, heats[best] / sum(heats) * within


def test_languages_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit_language_model(docs, per_language=30)
    rows = language.identify_languages(docs, model).filter("doc_id % 9 = 0 OR length(text) < 20").collect()
    assert len(rows) > 20
    for r in rows:
        if any(c.isalpha() for c in r.text or ""):
            pick, score = language_by_hand(model, r.text)
            assert r.score == pytest.approx(score, abs=1e-4) and (r.lang_pred == pick or score < 0.5)
        else:
            assert (r.lang_pred, r.score) == (language.UNDETERMINED, 0)


def test_folds(spark):
    rows = spark.createDataFrame([(0,), (17,), (None,)], "doc_id long").select(samples.id_remainder("doc_id", 5).alias("r"))
    import zlib

    assert [r.r for r in rows.collect()] == [zlib.crc32(b"0") % 5, zlib.crc32(b"17") % 5, 0]
