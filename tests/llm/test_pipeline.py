"""The pipeline, stage by stage, against plain Python; and the registered queries."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest
import sentencepiece as library
from test_copies import ties_by_hand
from test_text_operators import WHITE, WORDS, water_fill

import __spark_entry__ as entry
import corpus_pipeline
from legweave.llm import language
from legweave.llm.queries import REGISTRY
from legweave.llm.sentencepiece import MODEL_FILE

SF = "/root/testdata/sf0.001"


def held(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def stages(spark, docs, tmp_path):
    """The rows that go into and come out of each stage, written and read again in between."""
    out = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        out.append((name, docs.collect(), after.collect()))
        docs = after
    return out


def check_stages(found):
    (n1, a, b), (n2, _, c), (n3, _, d), (n4, _, e), (n5, _, f) = found
    assert [n1, n2, n3, n4, n5] == [name for name, _ in corpus_pipeline.STAGES]
    # All are in a learned language but for those without a letter, and perhaps long ones of signs and numbers.
    some = Counter((r.doc_id, r.text) for r in a if any(ch.isalpha() for ch in r.text or ""))
    assert not held(b) - some and all(sum(ch.isalpha() for ch in t) >= language.LEAST_LETTERS for _, t in some - held(b))
    assert sum((some - held(b)).values()) <= 0.02 * len(a)
    best = {}
    for r in b:
        key = (-len(r.text), -math.inf if r.doc_id is None else r.doc_id)
        bare = WHITE.sub("", r.text)
        best[bare] = min(best.get(bare, (key, r.doc_id, r.text)), (key, r.doc_id, r.text), key=lambda x: x[0])
    assert held(c) == Counter((doc_id, text) for _, doc_id, text in best.values())
    ties = ties_by_hand([(r.doc_id, r.text) for r in c], 80, 5)
    stays = {doc_id for doc_id, _, low in ties if doc_id == low}
    assert held(d) == Counter((r.doc_id, r.text) for r in c if r.doc_id in stays)
    sizes, longest, got = Counter(), defaultdict(int), Counter()
    for r in d:
        n = len(WORDS.findall(r.text))
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    for r in e:
        got[r.source] += len(WORDS.findall(r.text))
    assert set(held(e)) <= set(held(d)) and max(held(e).values()) <= 2
    for source, target in water_fill(sizes, (3, 1, 2), 1.5, 2).items():
        assert abs(got[source] - target) <= longest[source] / 2 + 1
    codec = library.SentencePieceProcessor(model_file=MODEL_FILE)
    texts = Counter((r.doc_id, tuple(r.ids), r.decoded) for r in f)
    assert texts == Counter((r.doc_id, tuple(codec.encode(r.text)), r.text.replace("▁", " ")) for r in e)


def test_stages_on_the_documents(spark, tmp_path):
    check_stages(stages(spark, spark.read.parquet(f"{SF}/documents.parquet"), tmp_path))


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    check_stages(stages(spark, odd_docs, tmp_path))


def test_stages_on_nothing(spark, no_docs, tmp_path):
    assert [rows for _, _, rows in stages(spark, no_docs, tmp_path)] == [[]] * 5


def test_language_decisions_act(spark):
    """A long text in another script goes; a short one, and texts of the learned languages, stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    foreign = " ".join("тхеа зжцшф ёъыэюя щьбгджз".split() * 40)
    more = [(-1, foreign, None), (-2, foreign[:20], None), (-3, "1234 " * 200, "en")]
    rows = spark.createDataFrame(more, "doc_id long, text string, lang string")
    both = docs.select("doc_id", "text", "lang").unionByName(rows)
    kept = {r.doc_id for r in corpus_pipeline.identify(spark, both, SF).collect()}
    assert kept == {r.doc_id for r in docs.collect()} | {-2}


def test_nothing_is_lost_where_no_language_can_be_learned(spark):
    rows = [(1, "clean prose " * 50, None, "a", 1), (2, "more of it", None, "a", 1), (3, "12 34", None, "b", 1), (4, None, None, "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.identify(spark, docs, SF).collect()} == {1, 2}


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "ids", "n_ids", "decoded"] and got.count() > 200


def test_registered(spark):
    names = set(entry.queries())
    assert set(REGISTRY) <= names and "pipeline" in REGISTRY
    assert {n.split("_")[0] for n in REGISTRY if n != "pipeline"} == {f"op{n}" for n in range(1, 14)}
    assert {n for n in REGISTRY if n in entry.oracle_sql()} == {"op4_chunk_recipes", "op12_collocations"}


@pytest.mark.parametrize(("name", "folder"), [("op4_chunk_recipes", SF), ("op12_collocations", "/root/testdata/sf0.01")])
def test_queries_equal_their_oracle(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    mine = REGISTRY[name].run(spark, folder).select(*names)
    assert sorted(map(tuple, mine.collect())) == sorted(cur.fetchall())


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_sentencepiece", {"doc_id", "ids", "n_ids", "decoded", "round_trip"}),
        ("op2_mix_sources", {"doc_id", "size", "source_size", "target", "taken"}),
        ("op3_pivot_range_join", {"vec_id", "n_links", "component_id", "kept"}),
        ("op5_markov_secrets", {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
        ("op8_jump_shards", {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}),
        ("op9_merged_transforms", {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"}),
        ("op10_shingle_tiles", {"doc_id", "n_shingles", "component_id"}),
    ],
)
def test_queries_return_every_row(spark, name, columns):
    table = "embeddings" if name.startswith("op3") else "documents"
    got = REGISTRY[name].run(spark, SF)
    assert set(got.columns) == columns
    assert got.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
