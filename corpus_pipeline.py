"""A corpus pipeline: each stage takes the documents that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legweave.llm import exact_dedup, jaccard, language, mixing, sentencepiece
from legweave.llm.sentencepiece import MODEL_FILE
from legweave.scratch import shared_root
from legweave.session import tune


# Bytes of rows that Spark hands to a Python worker at a time.  Executor and worker both hold them, the executor in buffers
# that double as they fill, so Spark's 64 MB cost several times that for each core.
BATCH_BYTES = "4m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with rows handed to Python in batches of BATCH_BYTES from then on."""

    @wraps(stage)
    def small(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return small


@in_small_batches
def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no language: without a letter, or long and below the model's floor (language.py).

    Where no language can be learned, all documents with a letter stay.
    """
    model = language.fit_language_model(docs)
    # Names that no column of the documents has.
    longest = max(map(len, docs.columns))
    names = ("l" * (longest + 1), "s" * (longest + 1))
    judged = language.identify_languages(docs, model, names=names)
    return judged.filter(language.in_some_language(F.col("text"), F.col(names[1]), model)).select(*docs.columns)


@in_small_batches
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of each group of copies that has the longest original text."""
    return exact_dedup.kept_documents(docs)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group tied together by a five-word shingle similarity of 0.8 or more."""
    return jaccard.kept_documents(docs, percent=80, size=5)


@in_small_batches
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix, and the text they give back."""
    coded = sentencepiece.encode_texts(docs.select("doc_id", "text"), MODEL_FILE, decode=True)
    return coded.select("doc_id", "ids", "n_ids", "decoded")


STAGES = [
    ("language ID", identify),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

# The mix draws by hashes and logarithms, and encoding merges pieces: neither has a form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again by the next."""
    tune(spark)
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
