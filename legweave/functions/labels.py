"""Threshold maps and class labels used by features and alerts."""

from __future__ import annotations

from itertools import chain as _chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from legweave.functions.numeric import c

# The largest calendar gap an alert accepts, by weeks between legs.
GAP_LIMIT_BY_WEEKS = {1: 0.1, 2: 0.175, 3: 0.25, 4: 0.325, 5: 0.40, 6: 0.475}

# Score above which a prediction counts as positive.
PREDICTION_CUTOFF = 0.85

# Lower bounds (exclusive) of the score tiers, highest first.
SCORE_TIERS = ((0.95, "top"), (0.9, "high"), (0.75, "good"), (0.5, "fair"), (0.0, "weak"))
NO_TIER = "none"

# Recognised results of comparing report-date sources.
DATE_AGREEMENT = ("samedate", "sameweek", "differentweek")
DATE_AGREEMENT_DEFAULT = "default"


def gap_limit(weeks: Column | str) -> Column:
    """Gap limit for the weeks column; a value outside the map is an error."""
    table = F.create_map(*[F.lit(x) for x in _chain.from_iterable(GAP_LIMIT_BY_WEEKS.items())])
    w = c(weeks).cast("int")
    return F.coalesce(
        F.try_element_at(table, w),
        F.raise_error(F.concat(F.lit("no gap limit for weeks "), F.coalesce(w.cast("string"), F.lit("null")))).cast(
            "double"
        ),
    )


def adjusted_gap(gap: Column | str, weeks: Column | str) -> Column:
    return c(gap) - gap_limit(weeks)


def prediction_label(score: Column | str) -> Column:
    return F.when(c(score) > PREDICTION_CUTOFF, 1).otherwise(0)


def score_tier(score: Column | str) -> Column:
    (bound, name), *rest = SCORE_TIERS
    tier = F.when(c(score) > bound, name)
    for bound, name in rest:
        tier = tier.when(c(score) > bound, name)
    return tier.otherwise(NO_TIER)


def iv_agreement(
    consensus: Column | str, max_exp_call: Column | str, max_exp_put: Column | str, exp_front: Column | str
) -> Column:
    """Whether the volatility peak of calls and puts sits on the front expiration."""
    return (
        F.when(c(consensus), "High")
        .when(c(max_exp_call) == c(exp_front), "Medium (Calls)")
        .when(c(max_exp_put) == c(exp_front), "Medium (Puts)")
        .otherwise("Low")
    )


def date_agreement(comment: Column | str) -> Column:
    text = F.lower(F.replace(F.trim(c(comment)), F.lit(" "), F.lit("")))
    return F.when(text.isin(*DATE_AGREEMENT), text).otherwise(DATE_AGREEMENT_DEFAULT)
