"""Column contracts of the market-data tables.

Names follow the vendor tables, except that ``right``, ``date`` and ``lambda``
are called ``opt_right``, ``trade_date`` and ``lambda_`` because they are SQL
words.  Dates are integers yyyymmdd, strikes are integers in thousandths.
"""

from __future__ import annotations

from pyspark.sql import types as T

CONTRACT_KEYS = ["symbol", "opt_right", "strike_milli", "exp", "trade_date"]
BAR_KEYS = [*CONTRACT_KEYS, "ms_of_day"]

# Vendor names to ours, applied where a landed file is read.
VENDOR_NAMES = {
    "root": "symbol",
    "expiration": "exp",
    "strike": "strike_milli",
    "right": "opt_right",
    "date": "trade_date",
    "lambda": "lambda_",
    "underlying_price": "underlying",
}


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# Types at rest of the bulk quote and greek slices (fixed values).
QUOTE_TYPES = _struct(
    {
        "exp": T.IntegerType(),
        "strike_milli": T.IntegerType(),
        "opt_right": T.StringType(),
        "ms_of_day": T.IntegerType(),
        "bid_size": T.IntegerType(),
        "bid": T.FloatType(),
        "ask_size": T.IntegerType(),
        "ask": T.FloatType(),
        "trade_date": T.IntegerType(),
    }
)
GREEK_TYPES = _struct(
    {
        "ms_of_day": T.IntegerType(),
        "delta": T.FloatType(),
        "theta": T.FloatType(),
        "vega": T.FloatType(),
        "rho": T.FloatType(),
        "epsilon": T.FloatType(),
        "lambda_": T.FloatType(),
        "implied_vol": T.FloatType(),
        "iv_error": T.FloatType(),
        "underlying": T.FloatType(),
        "trade_date": T.IntegerType(),
        "strike_milli": T.IntegerType(),
        "opt_right": T.StringType(),
    }
)

QUOTE_EXTRAS = ["bid_condition", "bid_exchange", "ask_condition", "ask_exchange"]

# A landed page of the tick service.  Items are kept as raw JSON text because
# one page may hold positional lists and another contract objects.
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("header", T.StructType([T.StructField("format", T.ArrayType(T.StringType()))])),
        T.StructField("response", T.ArrayType(T.StringType())),
    ]
)


def all_strings(names: list[str]) -> T.StructType:
    """A schema that reads every listed column as text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])
