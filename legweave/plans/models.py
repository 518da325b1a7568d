"""Fitted models at rest, and scoring by what was stored."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from legweave.plans.features import with_label

# A model file is sent to every worker, so its size is checked.
MOST_MODEL_BYTES = 256_000_000

Predict = Callable[[pd.DataFrame], pd.Series]

# Models that this worker has loaded, by the digest of their file.
_LOADED: dict[str, Predict] = {}


def save_pipeline(model: PipelineModel, path: str) -> None:
    """Stores a fitted Spark ML pipeline, replacing what is there."""
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_model_file(spark: SparkSession, content: bytes, path: str) -> None:
    """Stores the file of a Python model as a table of one row, on whatever file system ``path`` names."""
    if len(content) > MOST_MODEL_BYTES:
        raise ValueError(f"a model file has at most {MOST_MODEL_BYTES} bytes, not {len(content)}")
    spark.createDataFrame([(bytearray(content),)], "content binary").coalesce(1).write.mode("overwrite").parquet(path)


def load_model_file(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.schema("content binary").parquet(path).first()["content"])


def score_with_file(
    df: DataFrame, path: str, loads: Callable[[bytes], Predict], inputs: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Scores Arrow batches with the Python model stored at ``path``.

    The file is broadcast, and ``loads`` turns it into a function once per
    Python worker, not once per task or batch.  As in ``score_with_function``
    the kept columns travel with the scores.
    """
    keep, inputs = list(keep), list(inputs)
    content = load_model_file(df.sparkSession, path)
    digest = hashlib.sha256(content).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(content)
    sent = df.select(*dict.fromkeys([*keep, *inputs]))
    scores = [T.StructField(f"prediction_score_{i}", T.DoubleType()) for i in (0, 1)]
    out = T.StructType([*[sent.schema[n] for n in keep], *scores])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = loaded(digest, shared, loads)
        for pdf in batches:
            p = predict(pdf[inputs])
            yield pdf[keep].assign(prediction_score_0=1.0 - p, prediction_score_1=p)

    return with_label(sent.mapInPandas(score, out), "prediction_score_1")


def loaded(digest: str, shared, loads: Callable[[bytes], Predict]) -> Predict:
    """The model of a file, made on first use in this worker."""
    if digest not in _LOADED:
        _LOADED[digest] = loads(shared.value)
    return _LOADED[digest]
