"""The corpus operators' queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.llm import (
    collocations,
    embeddings,
    exact_dedup,
    jaccard,
    language,
    mixing,
    quality,
    samples,
    secrets,
    sentencepiece,
    sharding,
    spelling,
    substrings,
    toxicity,
)
from legweave.llm.sentencepiece import MODEL_FILE
from legweave.session import tune

SHARDS = 16
QUALITY_FLOOR = 0.3
TOXIC_FLOOR = 0.5


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Registers a query over an ``sf`` folder."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        REGISTRY[name] = Query(run, sql)
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_sentencepiece")
def op1(spark, sf_dir):
    """The ids of every whole text, and the text they give back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece.encode_texts(docs, MODEL_FILE, decode=True)
    same = F.translate(F.coalesce("text", F.lit("")), sentencepiece.SPACE, " ") == F.col("decoded")
    return coded.select("doc_id", "ids", "n_ids", "decoded", same.alias("round_trip"))


@query("op2_mix_sources")
def op2(spark, sf_dir):
    """The words that the mix takes of every document."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op3_pivot_range_join")
def op3(spark, sf_dir):
    """Near-duplicate vectors of one label."""
    return embeddings.near_embeddings(_table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH squeezed AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS bare
    FROM documents
), ranked AS (
    SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
           first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id
    FROM squeezed
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM ranked
"""


@query("op4_chunk_recipes", OP4_SQL)
def op4(spark, sf_dir):
    """Exact groups of documents but for white space."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@query("op5_markov_secrets")
def op5(spark, sf_dir):
    """Secrets of every document."""
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


@query("op6_byte_network")
def op6(spark, sf_dir):
    """A quality score of every document, learned from the labels outside the held-out fifth."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = samples.id_remainder("doc_id", 5) == 0
    model = quality.fit_quality(docs, labels.filter(~held_out))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_FLOOR).cast("int").alias("predicted")
    )


@query("op7_language_families")
def op7(spark, sf_dir):
    """The language of every document, learned outside the held-out third."""
    docs = _table(spark, sf_dir, "documents")
    held_out = samples.id_remainder("doc_id", 3) == 1
    model = language.fit_language_model(docs.filter(~held_out))
    found = language.identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op8_jump_shards")
def op8(spark, sf_dir):
    """Every document's shard among 16, its slot, and its shard among 17."""
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline in turn."""
    return corpus_pipeline.run(spark, sf_dir)


@query("op9_merged_transforms")
def op9(spark, sf_dir):
    """Every document without the bytes of 100-byte strings that start earlier."""
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"))


@query("op10_shingle_tiles")
def op10(spark, sf_dir):
    """Documents tied together by a shingle similarity of 80 per cent or more."""
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


@query("op11_string_kernel")
def op11(spark, sf_dir):
    """A toxicity score of every document, learned from the labels outside the held-out fifth."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = samples.id_remainder("doc_id", 5) == 0
    model = toxicity.fit_toxicity(docs, labels.filter(~held_out))
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= TOXIC_FLOOR).cast("int").alias("predicted")
    )


OP12_SQL = r"""
WITH pieces AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), grams AS (
    SELECT lang, k, phrase, count(*)::HUGEINT AS f
    FROM (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2),
                                                lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
          FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM pieces))
    GROUP BY ALL
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM grams WHERE k >= 2 AND f >= 30
), halves AS (
    SELECT lang, phrase, a, j, array_to_string(ws[1:j], ' ') AS first, array_to_string(ws[j + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
), cuts AS (
    SELECT h.lang, h.phrase, h.a, j, x.f AS l, y.f AS r, 2000000 * h.a // (x.f + y.f) AS score
    FROM halves h JOIN grams x ON x.lang = h.lang AND x.phrase = h.first
                  JOIN grams y ON y.lang = h.lang AND y.phrase = h.rest
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), covered AS (
    SELECT DISTINCT c.lang, c.phrase
    FROM (SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m:
                 list_transform(range(1, k - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))))) AS phrase
          FROM candidates WHERE k >= 3) longer
    JOIN candidates c ON c.lang = longer.lang AND c.phrase = longer.phrase AND 100 * longer.a >= 80 * c.a
), totals AS (
    SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM lowest ANTI JOIN covered USING (lang, phrase) JOIN totals USING (lang)
QUALIFY rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12(spark, sf_dir):
    """The 2,000 best phrases of every language."""
    return collocations.mine_collocations(_table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    """The words of all documents, and the near word that each is taken for."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))
