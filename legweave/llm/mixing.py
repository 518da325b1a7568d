"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legweave.llm.ordered import running_totals
from legweave.scratch import settle

WORD = r"[^\x20\x09-\x0D]+"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
# Signs that ordinary prose uses rarely; their share of the text lowers its weight.
RARE_SIGNS = "#$%&*+<=>@\\^_`{|}~"
LEAST_WEIGHT = 0.05


def word_count(text: Column) -> Column:
    """Words of the text; null has none."""
    marks = F.translate(F.regexp_replace(text, WORD, "w"), WHITE, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def prose_weight(text: Column) -> Column:
    """A quality weight above 0 and up to 1: the square of the share of ordinary signs."""
    whole = F.length(text)
    plain = F.length(F.translate(text, RARE_SIGNS, ""))
    share = F.when(whole > 0, plain / whole).otherwise(F.lit(0.0))
    return F.greatest(share * share, F.lit(LEAST_WEIGHT))


def exponential_key(key: Column, weight: Column) -> Column:
    """An exponential variable of rate ``weight``, drawn from a hash of ``key``: small keys are taken first."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit("mix")), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / weight


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, most_epochs: float) -> DataFrame:
    """``source_size`` and ``target`` per source, for a table (source, source_size).

    Sources by code point, null last, take the weights in turn.  Together they
    get ``share`` of all sizes by weight, none more than ``most_epochs`` times
    its size; what a source can't take goes to the others by weight.

    A source's cap over its weight is the level at which it is full.  In order
    of that level, the fill level stands before the first source that a sharing
    among it and all later ones leaves below its cap.
    """
    n = len(weights)
    table = F.array(*[F.lit(float(w)) for w in weights])
    ranked = running_totals(
        sources.withColumns({"__null": F.col("source").isNull(), "__one": F.lit(1).cast("long")}),
        ["__null", "source"],
        ["__one", "source_size"],
    )
    weighed = ranked.select(
        "source",
        "source_size",
        F.col("before_source_size").alias("start"),
        F.element_at(table, (F.col("before___one") % n + 1).cast("int")).alias("weight"),
    )
    weighed = weighed.withColumn("cap", F.col("source_size") * F.lit(float(most_epochs)))
    weighed = settle(weighed.withColumn("full_at", F.col("cap") / F.col("weight")), "weighed")
    whole = weighed.agg(
        (F.sum("source_size") * F.lit(float(share))).alias("__budget"), F.sum("weight").alias("__weights")
    )
    filled = running_totals(weighed, ["full_at", "source"], ["cap", "weight"]).crossJoin(F.broadcast(whole))  # one row
    level = (F.col("__budget") - F.col("before_cap")) / (F.col("__weights") - F.col("before_weight"))
    fill = filled.select("full_at", level.alias("level")).filter("level <= full_at").agg(F.max("level").alias("__level"))
    target = F.least("cap", F.coalesce(F.col("weight") * F.col("__level"), F.col("cap")))
    return weighed.crossJoin(F.broadcast(fill)).select(  # one row
        "source", "source_size", "start", target.alias("target")
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most_epochs: float = 2.0,
    quality: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """How many words of each document the mix takes.

    Columns: the id, ``text_hash`` (tells rows that share an id apart), ``size``
    (words), ``source_size``, ``target`` and ``taken`` of its source.  A source
    whose target is e times its size and a rest gets e whole epochs; the rest
    goes to its documents in order of their exponential keys, whose rate is the
    document's quality weight, until the rest is used up.  The document on that
    border gives the words that are left, so a source's words add up to its
    target rounded down.

    Other columns are ignored.  Null and empty texts have size 0 and give
    nothing; a null source is a source of its own.  Keys come from the id alone,
    so reruns agree; rows that repeat an id tie and are told apart by text, and
    rows alike in both by an arbitrary order.
    """
    text = F.col(text_col)
    quality = prose_weight(text) if quality is None else quality
    sized = settle(
        docs.select(
            F.col(id_col),
            F.col(source_col).alias("source"),
            F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
            word_count(text).alias("size"),
            exponential_key(F.col(id_col), F.coalesce(quality, F.lit(LEAST_WEIGHT))).alias("__key"),
            F.col(source_col).isNull().alias("__null"),
        ),
        "sized",
    )
    sources = settle(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = settle(source_targets(sources, weights, share, most_epochs), "targets")
    ordered = running_totals(sized, ["__null", "source", "__key", id_col, "text_hash"], ["size"])
    joined = ordered.join(targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    # Rounding in the last place must not turn a full source's two epochs into one.
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(F.lit(0))
    rest = F.floor(F.col("target") + 1e-6) - epochs * F.col("source_size")
    ahead = F.col("before_size") - F.col("start")
    extra = F.greatest(F.least(rest - ahead, F.col("size")), F.lit(0))
    return joined.select(
        id_col, "text_hash", "size", "source_size", "target", (epochs * F.col("size") + extra).cast("long").alias("taken"),
        epochs.cast("int").alias("epochs"),
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.

    Documents stay whole: the one on a source's border counts if half its words
    or more are taken.  Documents without words come once per epoch.
    """
    partial = F.col("taken") - F.col("epochs") * F.col("size")
    once_more = ((partial > 0) & (partial * 2 >= F.col("size"))).cast("int")
    copies = (
        mix_sources(docs, id_col=id_col, text_col=text_col, **how)
        .groupBy(F.col(id_col).alias("copy_id"), F.col("text_hash").alias("copy_hash"))
        .agg(F.max(F.col("epochs") + once_more).alias("copies"))
        .filter("copies > 0")
    )
    packed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0)).alias("hash")
    )
    taken = packed.join(copies, F.col("id").eqNullSafe(F.col("copy_id")) & (F.col("hash") == F.col("copy_hash")))
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
