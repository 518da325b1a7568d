"""The feature frame of the scoring model, and scoring itself."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legweave.functions.dates import cyclic_time_features
from legweave.functions.labels import adjusted_gap, prediction_label
from legweave.functions.numeric import finite_or_null
from legweave.operators.enrich import with_backtest_aggs, with_sector
from legweave.operators.trading_calendar import with_day_counts
from legweave.operators.trend import SLICE_ROWS, TREND_KEYS, TREND_MEASURES, price_trend, trend_slice, with_trade_sizes
from legweave.skew import salted_join

SCORE_KEYS = ["symbol", "strike", "opt_right", "exp_front", "weeks"]

# The model's input columns.  ``lambda_`` follows our naming.
MODEL_FEATURES = [
    "bid_front", "ask_front", "symbol", "bid_back", "ask_back",
    "delta_front", "theta_front", "vega_front", "rho_front", "epsilon_front", "lambda_front",
    "implied_vol_front", "iv_error_front", "underlying",
    "delta_back", "theta_back", "vega_back", "rho_back", "epsilon_back", "lambda_back",
    "implied_vol_back", "iv_error_back",
    "strike", "weeks", "noOfEsts", "epsForecast",
    "mark_front", "mark_back", "spread_front", "spreadPct_front", "spread_back", "spreadPct_back",
    "ask_cal", "bid_cal", "spread_cal", "mark_cal", "spreadPct_cal",
    "calCost", "undPricePctDiff", "calCostPct", "bdte", "bdtfexp", "ms_of_day",
    *[f"pre_{i}_{m}" for i in range(SLICE_ROWS) for m in TREND_MEASURES],
    "calCostPctMean", "calCostPctStd", "calCostPctMax", "calCostPctMin", "histCalCostCount", "histEarningsCount",
    "all_pl_pct_mean", "all_total_trades", "all_total_wins", "all_total_losses",
    "all_avg_trade_class", "all_avg_bdit", "all_win_rate",
    "undmean_pl_pct_mean", "undmean_total_trades", "undmean_total_wins", "undmean_total_losses",
    "undmean_avg_trade_class", "undmean_avg_bdit", "undmean_win_rate",
    "overmean_pl_pct_mean", "overmean_total_trades", "overmean_total_wins", "overmean_total_losses",
    "overmean_avg_trade_class", "overmean_avg_bdit", "overmean_win_rate",
    "fQuarterCount",
    "all_avg_trade_class_combined_grade", "undmean_avg_trade_class_combined_grade",
    "overmean_avg_trade_class_combined_grade",
    "calCostPctMeanDayZero", "iv_pct_diff", "pct_under_over_mean", "avgCalCost", "expectedCalCostPctDiff",
    "expectedCalCost", "targetPrice", "expectedProfit", "expectedProfitPct",
    "sector", "cos_day", "sin_day", "cos_month", "sin_month", "cos_weekday", "sin_weekday", "year",
    "calGapPctAdjusted", "min_entry_size", "max_entry_size", "min_exit_size", "max_exit_size",
]


def missing_features(df: DataFrame, wanted: Sequence[str] = MODEL_FEATURES) -> list[str]:
    """Model inputs that the frame does not have, in order."""
    return [n for n in wanted if n not in df.columns]


def require_features(df: DataFrame, wanted: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    absent = missing_features(df, wanted)
    if absent:
        raise ValueError(f"columns missing for the model: {absent}")
    return df


def no_infinities(df: DataFrame) -> DataFrame:
    """Infinite and NaN values of every floating column become null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({n: finite_or_null(n) for n in floats})


def feature_frame(
    snapshot: DataFrame, sectors: DataFrame, backtest: DataFrame, log: DataFrame, holidays: Sequence[int]
) -> DataFrame:
    """Time, sector, backtest, size, gap and trend features of a snapshot.

    ``log`` holds earlier snapshots (symbol, weeks, trade_date, report_date,
    calCostPct and the four sizes).  Rows without a sector, backtest or trend
    slice are dropped, as the model cannot score them.
    """
    frame = snapshot.withColumns(cyclic_time_features("trade_date"))
    frame = with_backtest_aggs(with_sector(frame, sectors), backtest, latest=True)
    frame = no_infinities(with_trade_sizes(frame))
    frame = frame.withColumn("calGapPctAdjusted", adjusted_gap("calGapPct", "weeks"))
    trend = snapshot_trend(log, holidays)
    return salted_join(frame, trend_slice(frame, trend), TREND_KEYS)


def snapshot_trend(log: DataFrame, holidays: Sequence[int]) -> DataFrame:
    """Price trend of earlier snapshots by business days to their report."""
    return price_trend(with_day_counts(with_trade_sizes(log), holidays, "trade_date", "report_date", "earnings"))


def score_with_model(df: DataFrame, model: Transformer) -> DataFrame:
    """Scores a frame with a fitted Spark ML model that yields ``probability``."""
    scored = model.transform(df)
    p = vector_to_array("probability")
    return with_label(
        scored.withColumns({"prediction_score_0": p[0], "prediction_score_1": p[1]}), "prediction_score_1"
    )


def score_with_function(
    df: DataFrame, predict_proba: Callable[[pd.DataFrame], pd.Series], inputs: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Scores Arrow batches with any Python model.

    Only ``keep`` and ``inputs`` are sent to Python; the kept columns come back
    with the scores, so rows and scores are never matched by position.
    """
    keep, inputs = list(keep), list(inputs)
    sent = df.select(*dict.fromkeys([*keep, *inputs]))
    out = T.StructType(
        [
            *[sent.schema[n] for n in keep],
            T.StructField("prediction_score_0", T.DoubleType()),
            T.StructField("prediction_score_1", T.DoubleType()),
        ]
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = predict_proba(pdf[inputs])
            yield pdf[keep].assign(prediction_score_0=1.0 - p, prediction_score_1=p)

    return with_label(sent.mapInPandas(score, out), "prediction_score_1")


def with_label(df: DataFrame, score: str) -> DataFrame:
    return df.withColumn("prediction_label", prediction_label(score))


def scores_back(snapshot: DataFrame, scored: DataFrame, keys: Sequence[str] = SCORE_KEYS) -> DataFrame:
    """Scores on every snapshot row; null where the model had no features.

    ``keys`` name a row: with several trade dates in one table theirs belongs to them.
    """
    scores = scored.select(*keys, "prediction_label", "prediction_score_0", "prediction_score_1")
    return salted_join(snapshot, scores, keys, "left")


def matthews(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Confusion counts and the Matthews correlation (0 when undefined)."""
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).cast("double").alias("tp"),
        F.count_if((y == 0) & (p == 0)).cast("double").alias("tn"),
        F.count_if((y == 0) & (p == 1)).cast("double").alias("fp"),
        F.count_if((y == 1) & (p == 0)).cast("double").alias("fn"),
    )
    tp, tn, fp, fn = (F.col(n) for n in ("tp", "tn", "fp", "fn"))
    spread = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    mcc = F.coalesce(F.try_divide(tp * tn - fp * fn, spread), F.lit(0.0))
    return counts.withColumn("mcc", mcc).withColumn("loss", -mcc)
