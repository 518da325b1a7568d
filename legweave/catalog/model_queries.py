"""Queries for features and scoring (M*)."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from legweave import fixtures as fx
from legweave.catalog.projection_queries import GAP_SQL
from legweave.catalog.registry import query
from legweave.functions import labels as lb
from legweave.operators.alerts import gap_below_limit
from legweave.operators.enrich import with_sector
from legweave.plans import features as ft

NUMERIC = ["calCost", "calGapPct", "pct_under_over_mean", "bdte", "weeks"]


@query(
    "m01_row_rules_as_columns",
    f"""SELECT row_id, "calGapPct" - {GAP_SQL} AS "calGapPctAdjusted", CASE WHEN prediction_score_1 > 0.85e0 THEN 1 ELSE 0 END AS prediction_label,
      CAST(strftime(make_timestamp("lastUpdated" * 1000000), '%Y%m%d') AS INT) AS alert_date FROM candidates WHERE "calGapPct" < {GAP_SQL}""",
)
def m01(spark, sf):
    """Rules that are row functions elsewhere, as column expressions."""
    rows = gap_below_limit(fx.candidates(spark, sf))
    return rows.select(
        "row_id",
        lb.adjusted_gap("calGapPct", "weeks").alias("calGapPctAdjusted"),
        lb.prediction_label("prediction_score_1").alias("prediction_label"),
        F.date_format(F.timestamp_seconds("lastUpdated"), "yyyyMMdd").cast("int").alias("alert_date"),
    )


# A fixed logistic model, to check scoring through Python against SQL.
WEIGHTS = {"calCost": -0.25, "calGapPct": 2.0, "pct_under_over_mean": -1.5, "bdte": 0.0625, "weeks": 0.5}


def logistic(pdf):
    z = sum(pdf[n].to_numpy(dtype="float64") * w for n, w in WEIGHTS.items())
    return 1.0 / (1.0 + np.exp(-z))


Z_SQL = " + ".join(f'"{n}" * ({w}e0)' for n, w in WEIGHTS.items())


@query(
    "m03_score_with_function",
    f"""SELECT row_id, round(p, 9) AS prediction_score_1, round(1 - p, 9) AS prediction_score_0, CASE WHEN p > 0.85e0 THEN 1 ELSE 0 END AS prediction_label
      FROM (SELECT row_id, 1 / (1 + exp(-({Z_SQL}))) AS p FROM candidates)""",
)
def m03(spark, sf):
    scored = ft.score_with_function(fx.candidates(spark, sf), logistic, list(WEIGHTS), ["row_id"])
    return scored.withColumns({f"prediction_score_{i}": F.round(f"prediction_score_{i}", 9) for i in (0, 1)})


# Bound of the fit: so many labelled rows, the first in the order of a hash of the id.
FIT_ROWS = 20_000


@query("m03_score_with_model", "SELECT row_id, 1.0e0 AS whole, true AS in_range, true AS labelled FROM candidates SEMI JOIN sectors USING (symbol)")
def m03_model(spark, sf):
    """Fits a small boosted-tree model on a bounded sample of scored calendars and scores them all.

    Per row: the two scores add up to 1, lie in 0 to 1, and the label follows from them.
    """
    rows = with_sector(fx.candidates(spark, sf), fx.sectors(spark, sf)).withColumn(
        "label", F.when((F.col("calCost") < 4) & (F.col("calGapPct") < 0.2), 1.0).otherwise(0.0)
    )
    model = Pipeline(
        stages=[
            StringIndexer(inputCol="sector", outputCol="sector_idx", handleInvalid="keep"),
            VectorAssembler(inputCols=[*NUMERIC, "sector_idx"], outputCol="features", handleInvalid="keep"),
            GBTClassifier(labelCol="label", featuresCol="features", maxIter=3, maxDepth=3, seed=7),
        ]
    ).fit(rows.orderBy(F.xxhash64("row_id"), "row_id").limit(FIT_ROWS))
    p0, p1 = F.col("prediction_score_0"), F.col("prediction_score_1")
    return ft.score_with_model(rows, model).select(
        "row_id",
        F.round(p0 + p1, 9).alias("whole"),
        (p0.between(0, 1) & p1.between(0, 1)).alias("in_range"),
        (F.col("prediction_label") == F.when(p1 > 0.85, 1).otherwise(0)).alias("labelled"),
    )


# Model inputs that the table of scored calendars has; none of them is ever null there.
HELD = ["symbol", "bdte", "weeks", "histEarningsCount", "calCost", "pct_under_over_mean", "spreadPct_front", "spreadPct_back",
        "spreadPct_cal", "undPricePctDiff", "undmean_avg_trade_class_combined_grade"]
_NAMES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(ft.MODEL_FEATURES))
_HELD_NULLS = " ".join(f"""WHEN '{n}' THEN count(*) FILTER (WHERE "{n}" IS NULL)""" for n in HELD)


@query(
    "m04_missing_features",
    f"""SELECT place, name, count(*) AS n_rows, CASE name {_HELD_NULLS} ELSE count(*) END AS n_null
      FROM candidates, (VALUES {_NAMES}) f(place, name) GROUP BY 1, 2""",
)
def m04(spark, sf):
    """How many rows of the scored calendars lack each model input, by one pass over all of them."""
    rows = fx.candidates(spark, sf)
    lacking = [F.count_if(F.col(n).isNull()) if n in rows.columns else F.count(F.lit(1)) for n in ft.MODEL_FEATURES]
    counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), *[x.alias(f"n{i}") for i, x in enumerate(lacking)])
    each = [F.struct(F.lit(i).alias("place"), F.lit(n).alias("name"), F.col(f"n{i}").alias("n_null")) for i, n in enumerate(ft.MODEL_FEATURES)]
    return counts.select("n_rows", F.explode(F.array(*each)).alias("f")).select("f.place", "f.name", "n_rows", "f.n_null")
