"""Exact deduplication by recipes of content-defined chunks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.llm.batches import blocks, give_back, list_column, utf8
from legweave.scratch import settle

WHITE = r"[\x20\x09-\x0D]+"
# A border stands where the hash of the last 32 bytes ends in so many zero bits: chunks of 2 KiB on average.
WINDOW = 32
BORDER_BITS = 11
# A chunk without a border, as in one sign repeated, is cut at this many bytes.
LONGEST = 1 << 16
# One random number per byte value, drawn from a fixed seed so that every worker cuts alike.
GEAR = np.random.default_rng(20_240_229).integers(1 << 32, size=256, dtype=np.uint32)


def borders(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of the documents in ``data`` start, and how many each document has.

    A border depends on the 32 bytes before it alone, so equal passages are cut
    alike wherever they stand, and equal documents have equal chunks.
    """
    rolled = GEAR[data]
    width = 1
    while width < WINDOW:  # the sum over the last 2 * width bytes from that over the last width
        rolled[width:] += rolled[:-width] << np.uint32(width)
        width *= 2
    ends = np.flatnonzero(rolled >> np.uint32(32 - BORDER_BITS) == 0) + 1
    row = np.searchsorted(starts, ends, "right") - 1
    inside = (row < len(starts) - 1) & (ends - starts[np.minimum(row, len(starts) - 1)] >= WINDOW)
    filled = np.unique(starts[:-1][np.diff(starts) > 0])
    cuts = np.union1d(filled, ends[inside])
    lengths = np.diff(np.append(cuts, starts[-1]))
    if len(lengths) and lengths.max() > LONGEST:
        parts = -(-lengths // LONGEST)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        cuts = np.repeat(cuts, parts) + within * LONGEST
    return cuts, np.searchsorted(cuts, starts[1:]) - np.searchsorted(cuts, starts[:-1])


def _chunked(hash_bits: int, emit: str):
    """Arrow batches with a column ``text`` last: its recipe instead (``recipe``), or a row per chunk (``chunks``)."""
    keep = (1 << hash_bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for lo, hi in blocks(starts):
                part = np.ascontiguousarray(data[starts[lo] : starts[hi]])
                cuts, counts = borders(part, starts[lo : hi + 1] - starts[lo])
                view, ends = memoryview(part), np.append(cuts[1:], len(part))
                pieces = [view[a:b] for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)]
                hashes = np.array([xxhash.xxh3_64_intdigest(p) & keep for p in pieces], np.uint64).view(np.int64)
                rows = batch.slice(lo, hi - lo)
                if emit == "recipe":
                    recipe = list_column(np.append(0, np.cumsum(counts)), pa.array(hashes)).cast(pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([*rows.columns[:-1], recipe], [*rows.schema.names[:-1], "recipe"])
                    continue
                owner = np.repeat(np.arange(hi - lo), counts)
                pos = np.arange(len(cuts)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.take(pa.array(owner)) for c in rows.columns[:-1]],
                        pa.array(pos.astype(np.int32)),
                        pa.array(hashes),
                        pa.array([bytes(p) for p in pieces], pa.binary()),
                    ],
                    [*rows.schema.names[:-1], "pos", "chunk_hash", "chunk"],
                )
        give_back()

    return run


def squeezed(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_bits: int = 64) -> DataFrame:
    """Groups of documents that are equal but for white space, and the one of each that stays.

    Columns: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (of
    the squeezed text).  The row with the most code points in its original text
    stays, then the smallest id; a null id comes first.

    Every squeezed text becomes its recipe, the ordered list of its chunks'
    identifiers.  An identifier is the chunk's hash, verified over the whole
    table: each distinct chunk is moved once, and where two chunks share a hash
    (``hash_bits`` below 64 makes that happen in tests) their rank among each
    other joins the recipe.  Documents are then grouped by recipe, so long
    texts are not moved again.

    Null texts count as empty, and all empty texts are one group.  Rows that
    repeat an id and a text are one document, marked alike.  Other columns are
    ignored; an empty table gives no rows.
    """
    text = F.col(text_col)
    base = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.length(text), F.lit(0)).alias("points"), squeezed(text).alias("text")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    hashed = base.select("id", "points", F.sha2(F.col("text"), 256).alias("sha"), "text")
    recipes = hashed.mapInArrow(
        _chunked(hash_bits, "recipe"), f"id {kind}, points int, sha string, recipe array<bigint>"
    )
    recipes = settle(recipes, "recipes")
    chunks = base.select("text").mapInArrow(_chunked(hash_bits, "chunks"), "pos int, chunk_hash bigint, chunk binary")
    chunks = chunks.select("chunk_hash", "chunk").distinct()
    clashes = settle(chunks.groupBy("chunk_hash").count().filter("count > 1").select("chunk_hash"), "clashes")
    if not clashes.isEmpty():
        recipes = _told_apart(hashed, recipes, chunks, clashes, hash_bits, kind)
    key = ["recipe"] + [c for c in recipes.columns if c == "ranks"]
    best = F.min(F.struct((-F.col("points")).alias("longest"), "id"))
    groups = recipes.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), best.id.alias("keep_id"))
    # Written first, so that a group with a large share of the rows can be split in the join.
    groups = settle(groups, "groups")
    return recipes.join(groups, key).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _told_apart(hashed, recipes, chunks, clashes, hash_bits, kind) -> DataFrame:
    """The recipes with ``ranks``: for chunks that share a hash, their rank among these."""
    by_bytes = Window.partitionBy("chunk_hash").orderBy("chunk")
    ranked = chunks.join(clashes, "chunk_hash", "left_semi").withColumn("rank", F.row_number().over(by_bytes))
    again = hashed.select("sha", "text").mapInArrow(
        _chunked(hash_bits, "chunks"), "sha string, pos int, chunk_hash bigint, chunk binary"
    )
    ranks = (
        again.join(ranked, ["chunk_hash", "chunk"])
        .select("sha", "pos", "rank")
        .distinct()
        .groupBy("sha")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "rank"))).alias("ranks"))
    )
    return settle(
        recipes.join(ranks, "sha", "left").withColumn(
            "ranks", F.coalesce("ranks", F.array().cast("array<struct<pos:int,rank:int>>"))
        ),
        "ranked",
    )


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of ``docs``; one row for rows that repeat an id and a text."""
    stay = settle(
        exact_groups(docs, id_col, text_col)
        .filter("kept")
        .groupBy(F.col(id_col).alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
        .agg(F.count(F.lit(1)).alias("rows")),
        "stay",
    )
    packed = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.sha2(squeezed(F.col(text_col)), 256).alias("sha")
    )

    def rows_of(keys: DataFrame) -> DataFrame:
        same = packed["id"].eqNullSafe(keys["stay_id"]) & (packed["sha"] == keys["stay_sha"])
        return packed.join(keys, same, "left_semi")

    once = rows_of(stay.filter("rows = 1")).select("row.*")
    again = settle(stay.filter("rows > 1"), "again")
    if again.isEmpty():
        return once
    order = [F.col("row").getField(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    w = Window.partitionBy("id", "sha").orderBy(*order)
    first = rows_of(again).withColumn("nth", F.row_number().over(w)).filter("nth = 1")
    return once.unionByName(first.select("row.*"))
