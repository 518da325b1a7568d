"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, and exact intersection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.llm.batches import blocks, give_back, list_column, ragged, utf8
from legweave.llm.bitsets import BITS, bit_set, contains
from legweave.llm.components import components
from legweave.llm.shingles import mixed, shingle_sets
from legweave.scratch import discard, release, settle

# Common shingles that come last in the order of prefixes: at most so many, each in so many documents.
COMMON, COMMON_FROM = 200_000, 64
# Documents that share a shingle before it is reported; they are counted over so many documents or members together,
# in ranges of their hashes' first bits.
SEEN_IN_BATCH = 4
SEEN_ROWS, SEEN_MEMBERS, RANGE_BITS = 10_000, 4_000_000, 4
# Bits of a signature: its set's size or more, in powers of two, between these.
LEAST_BITS, MOST_BITS = 64, 1 << 15
# Rows of a block of a large tile, rows of a task, pairs compared at a time.
PART, TASK_ROWS, PAIRS = 4_096, 4_000, 400_000
# Tiles above this size are first compared with one of their members only; rows so compared at a time.
STAR, STAR_ROWS = 512, 2_000
# Partners that each row offers in the first round, and times as many in each one after.
FIRST_BEST, GROWTH = 2, 16


def signature(one: np.ndarray) -> bytes:
    """The parities of a set's hashes per bit; two signatures differ in no more bits than the sets in members."""
    bits = LEAST_BITS
    while bits < min(len(one), MOST_BITS):
        bits *= 2
    spots = (mixed(one * np.uint64(0xD6E8FEB86659FD93)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(spots, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _profiles(size: int):
    """Texts to rows of their set (``n``, two fingerprints, signature), and shingles common in some thousands of them."""

    def often(members: list[np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        seen, times = _seen_often(members, SEEN_IN_BATCH)
        k = len(seen)
        shingles = pa.array(seen.view(np.int64))
        return _profile_rows(
            pa.nulls(k, id_type), times, seen.view(np.int64), np.zeros(k, np.int64), pa.nulls(k, pa.binary()), shingles
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, rows = [], 0
        for batch in batches:
            data, starts = utf8(batch.column("body"))
            for lo, hi in blocks(starts):
                at, sets = shingle_sets(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], size)
                each = [sets[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                n = np.diff(at).astype(np.int64)
                yield _profile_rows(
                    batch.column("id").slice(lo, hi - lo),
                    n,
                    np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in each], np.uint64).view(np.int64),
                    np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in each], np.uint64).view(np.int64),
                    pa.array([signature(s) if len(s) else None for s in each], pa.binary()),
                    pa.nulls(hi - lo, pa.int64()),
                )
                sets.sort()
                members.append(sets)
                rows += hi - lo
            if rows >= SEEN_ROWS or sum(map(len, members)) >= SEEN_MEMBERS:
                yield often(members, batch.schema.field("id").type)
                members, rows = [], 0
        if members:
            yield often(members, batch.schema.field("id").type)
        del members
        give_back()

    return run


def _seen_often(members: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The values that come ``least`` times or more in all of these sorted arrays, sorted, and how often.

    A range of values is put together at a time, and as most come once, only those that reach ``least`` are counted.
    """
    lows = np.arange(1, 1 << RANGE_BITS, dtype=np.uint64) << np.uint64(64 - RANGE_BITS)
    ranges = zip(*[np.split(one, np.searchsorted(one, lows)) for one in members], strict=True)
    found = []
    for parts in ranges:
        both = np.sort(np.concatenate(parts))
        last = both[least - 1 :]
        found.append(np.unique(last[last == both[: len(last)]], return_counts=True))
    seen, times = (np.concatenate(x) for x in zip(*found, strict=True))
    return seen, times + (least - 1)


def _profile_rows(ids, n, k1, k2, sig, shingle) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n, pa.int64()), pa.array(k1), pa.array(k2), sig, shingle], ["id", "n", "k1", "k2", "sig", "shingle"]
    )


def _prefixes(size: int, percent: int, common: np.ndarray, only=None):
    """Texts to rows (shingle, k1, n): the members of each set's prefix, rare ones first, and its size.

    With ``only``, a broadcast bitmap, members that are not in it are left out.

    Sets that reach ``percent`` share a member of their prefixes, whatever the
    order is, if it is the same for all: first members that aren't common,
    then common ones, each by hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("body"))
            for lo, hi in blocks(starts):
                at, sets = shingle_sets(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], size)
                keys = [xxhash.xxh3_64_intdigest(sets[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                n = np.diff(at)
                late = np.zeros(len(sets), bool)
                if len(common) and len(sets):
                    late = common[np.minimum(np.searchsorted(common, sets), len(common) - 1)] == sets
                owner = np.repeat(np.arange(len(n)), n)
                early_so_far = np.append(0, np.cumsum(~late))
                early = early_so_far[at[1:]] - early_so_far[at[:-1]]
                place = np.arange(len(sets)) - at[:-1][owner]
                early_place = early_so_far[:-1] - early_so_far[at[:-1]][owner]
                rank = np.where(late, early[owner] + place - early_place, early_place)
                _, once = np.unique(np.array(keys, np.uint64), return_index=True)
                single = np.zeros(len(n), bool)
                single[once] = True
                kept = (rank < (n - -(-percent * n // 100) + 1)[owner]) & single[owner]
                if only is not None:
                    kept &= contains(only.value, sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets[kept].view(np.int64)),
                        pa.array(np.array(keys, np.uint64).view(np.int64)[owner[kept]]),
                        pa.array(n[owner[kept]].astype(np.int32)),
                    ],
                    ["shingle", "k1", "n"],
                )
        give_back()

    return run


def _sets(size: int):
    """Rows (id, body) to (id, members): the sorted set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("body"))
            for lo, hi in blocks(starts):
                at, sets = shingle_sets(data[starts[lo] : starts[hi]], starts[lo : hi + 1] - starts[lo], size)
                members = list_column(at, pa.array(sets.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), members], ["id", "members"])
        give_back()

    return run


def _linked(percent: int):
    """Pairs (a, b, one, two) of sorted sets that reach ``percent``, by exact intersection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("one", "two"):
                column = batch.column(name)
                sizes = column.value_lengths().to_numpy(zero_copy_only=False)
                sides.append((column.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(sizes))))
            (x, xs), (y, ys) = sides
            keep = []
            for r in range(batch.num_rows):
                p, q = x[xs[r] : xs[r + 1]], y[ys[r] : ys[r + 1]]
                spot = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[spot] == p).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class _Signatures:
    """Signatures of a task's rows, folded to any width that two of them share."""

    def __init__(self, column: pa.ChunkedArray):
        raw = column.to_pylist()
        self.words = np.array([len(b) // 8 for b in raw], np.int64)
        self.folded = {}
        for width in np.unique(self.words).tolist():
            table = np.zeros((len(raw), width), np.uint64)
            for r in np.flatnonzero(self.words >= width).tolist():
                table[r] = np.bitwise_xor.reduce(np.frombuffer(raw[r], np.uint64).reshape(-1, width), axis=0)
            self.folded[width] = table

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bits rows i and j differ in, at the smaller width of the two."""
        out = np.zeros(len(i), np.int64)
        width = np.minimum(self.words[i], self.words[j])
        for w in np.unique(width).tolist():
            on = np.flatnonzero(width == w)
            table = self.folded[w]
            for lo in range(0, len(on), max(1, 4_000_000 // w)):
                some = on[lo : lo + max(1, 4_000_000 // w)]
                out[some] = np.bitwise_count(table[i[some]] ^ table[j[some]]).sum(1)
        return out


def _reaches(n: np.ndarray, apart: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of sizes n that differ in so many bits may reach ``percent``."""
    return apart * (100 + percent) <= (n[i] + n[j]) * (100 - percent)


def _tile(percent: int, best: int):
    """One task's cells: pairs (a, b) of different components that their signatures let through.

    Rows of a cell are sorted by size, so each meets the band of sizes that can
    reach ``percent``; rows of side 0 meet all others, those of sides 1 and 2
    the other side.  Each row gives its ``best`` partners by signature, and
    ``more`` says that it has others.
    """

    def run(table: pa.Table) -> pa.Table:
        order = [("shingle", "ascending"), ("lo", "ascending"), ("hi", "ascending"), ("n", "ascending"), ("c", "ascending")]
        table = table.sort_by(order)
        n, c, comp, side = (table[k].to_numpy() for k in ("n", "c", "comp", "side"))
        cell = [table[k].to_numpy() for k in ("shingle", "lo", "hi")]
        fresh = np.append(True, np.logical_or.reduce([x[1:] != x[:-1] for x in cell]))
        tile = np.cumsum(fresh) - 1
        begin = np.flatnonzero(fresh)
        signatures = _Signatures(table["sig"])
        key = tile * (int(n.max()) + 1)
        band = np.searchsorted(key + n, key + np.minimum(100 * n // percent, n.max()), "right")
        partners = band - np.arange(len(n)) - 1
        alike = np.minimum.reduceat(comp, begin) == np.maximum.reduceat(comp, begin)
        partners[alike[tile]] = 0
        upto = np.cumsum(partners)
        lo = 0
        left, right, bits = [], [], []
        while lo < len(n):
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + PAIRS, "right")))
            i = np.repeat(np.arange(lo, hi), partners[lo:hi])
            j = ragged(np.arange(lo, hi) + 1, partners[lo:hi])
            differ = (comp[i] != comp[j]) & ((side[i] == 0) | (side[i] != side[j]))
            i, j = i[differ], j[differ]
            apart = signatures.apart(i, j)
            close = _reaches(n, apart, i, j, percent)
            left.append(i[close])
            right.append(j[close])
            bits.append(apart[close])
            lo = hi
        i, j, more = _best_of(*(np.concatenate(x) for x in (left, right, bits)), best)
        a, b = np.minimum(c[i], c[j]), np.maximum(c[i], c[j])
        pairs = np.unique(np.stack([a, b, more.astype(np.int64)]), axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1], "more": pairs[2].astype(bool)})

    return run


def _near_centre(percent: int):
    """Rows (c, n, sig, z, zn, zsig) to the pairs (a, b) of c and z that their signatures let through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STAR_ROWS):
                some = batch.slice(at, STAR_ROWS)
                signatures = _Signatures(pa.chunked_array([some["sig"], some["zsig"]]))
                n = np.concatenate([some["n"].to_numpy(), some["zn"].to_numpy()])
                i = np.arange(some.num_rows)
                j = i + some.num_rows
                close = _reaches(n, signatures.apart(i, j), i, j, percent)
                c, z = some["c"].to_numpy()[close], some["z"].to_numpy()[close]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(c, z)), pa.array(np.maximum(c, z))], ["a", "b"])

    return run


def _stars(large: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, more) of the rows of each tile with one of its members, the same for tiles of the same rows.

    Every row meets its centre by a join; no row is repeated for the others of its tile.
    """
    least = F.min(F.struct(F.xxhash64("k1").alias("h"), "k1", "c", "n")).alias("z")
    centres = large.groupBy("shingle").agg(least).select(
        "shingle", F.col("z.k1").alias("zk"), F.col("z.c").alias("z"), F.col("z.n").alias("zn")
    )
    centres = settle(centres, "centres")
    fits = F.least("n", "zn") * 100 >= F.greatest("n", "zn") * percent
    met = large.join(centres, "shingle").filter((F.col("c") != F.col("z")) & fits)
    met = met.select("k1", "c", "n", "zk", "z", "zn").distinct().join(classes.select("k1", "c", "n", "sig"), ["k1", "c", "n"])
    theirs = classes.select(F.col("k1").alias("zk"), F.col("c").alias("z"), F.col("n").alias("zn"), F.col("sig").alias("zsig"))
    theirs = theirs.join(centres.select("zk", "z", "zn").distinct(), ["zk", "z", "zn"], "left_semi")
    both = met.join(theirs, ["zk", "z", "zn"]).select("c", "n", "sig", "z", "zn", "zsig")
    return both.mapInArrow(_near_centre(percent), "a long, b long").withColumn("more", F.lit(False))


def _cells(rows: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Rows (shingle, lo, hi, side, k1, c, n, comp): each row once for every cell of its tile that it is compared in.

    A tile whose rows are all tied together is left out.  A tile of up to PART
    rows is one cell.  A larger one is cut into blocks of about PART rows: by
    bands of sizes, where only neighbours can reach ``percent``; by whether a
    row belongs to the tile's largest component, whose rows do not meet each
    other; and by hash.  A cell is two such blocks, or one with itself.
    """
    tied = rows.join(comps.select(F.col("id").alias("c"), "component"), "c", "left")
    tied = settle(tied.select("shingle", "k1", "c", "n", F.coalesce("component", "c").alias("comp")), "tied")
    counts = tied.groupBy("shingle", "comp").agg(F.count(F.lit(1)).alias("k"))
    tiles = counts.groupBy("shingle").agg(
        F.sum("k").alias("rows"), F.count(F.lit(1)).alias("comps"), F.max(F.struct("k", "comp")).alias("largest")
    )
    tiles = settle(tiles.filter("comps > 1").select("shingle", "rows", F.col("largest.comp").alias("largest")), "tiles")
    # A little wider than the ratio of sizes that can reach percent, so that rounding puts no such pair two bands apart.
    width = math.log(100 / percent) * 1.000001
    band = F.floor(F.log("n") / width) if percent < 100 else F.col("n")
    left = tied.join(tiles, "shingle").select(
        "shingle", "k1", "c", "n", "comp", "rows", (F.col("comp") == F.col("largest")).alias("main"), band.cast("long").alias("band")
    )
    left = settle(left, "left")
    discard(tied, tiles)
    names = ["shingle", "lo", "hi", "side", "k1", "c", "n", "comp"]
    zero = F.lit(0).cast("long")
    whole = left.filter(F.col("rows") <= PART).withColumns({"lo": zero, "hi": zero, "side": F.lit(0)}).select(*names)
    large = left.filter(F.col("rows") > PART)
    blocks = large.groupBy("shingle", "band", "main").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    meets = (
        blocks.withColumn("at", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
        .groupBy("shingle", "at")
        .agg(F.collect_list(F.struct("band", "main", "parts")).alias("meets"))
        .withColumnRenamed("at", "band")
    )
    meets = settle(meets, "meets")

    def block(band, main, part):
        return F.shiftleft(band, 30) + F.shiftleft(main.cast("long"), 29) + part

    own = F.filter("meets", lambda m: (m["band"] == F.col("band")) & (m["main"] == F.col("main")))[0]["parts"]
    other = F.flatten(
        F.transform(
            F.filter("meets", lambda m: ~(m["main"] & F.col("main"))),
            lambda m: F.transform(F.sequence(zero, m["parts"] - 1), lambda part: block(m["band"], m["main"], part)),
        )
    )
    dealt = large.join(meets, ["shingle", "band"]).withColumn(
        "mine", block(F.col("band"), F.col("main"), F.pmod(F.xxhash64("c"), own))
    )
    dealt = dealt.withColumn("other", F.explode(other)).withColumns(
        {
            "lo": F.least("mine", "other"),
            "hi": F.greatest("mine", "other"),
            "side": F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2),
        }
    )
    cells = settle(whole.unionByName(dealt.select(*names)), "cells")
    discard(left, meets)
    return cells


def _offers(cells: DataFrame, classes: DataFrame, percent: int, best: int) -> DataFrame:
    """Pairs (a, b, more) that the cells offer; a task has about TASK_ROWS rows, or one cell."""
    tasks = max(1, cells.count() // TASK_ROWS)
    task = F.pmod(F.xxhash64("shingle", "lo", "hi"), F.lit(tasks)).alias("task")
    # Signatures join the rows on their way to the cells, and are not written with them.
    signed = cells.join(classes.select("k1", "c", "n", "sig"), ["k1", "c", "n"])
    return (
        signed.select(task, "shingle", "lo", "hi", "side", "c", "comp", "n", "sig")
        .groupBy("task")
        .applyInArrow(_tile(percent, best), "a long, b long, more boolean")
    )


def _best_of(i: np.ndarray, j: np.ndarray, d: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that are among the ``best`` of either row, and whether either has others."""
    if not len(i):
        return i, j, np.empty(0, bool)
    kept, more = np.zeros(len(i), bool), np.zeros(len(i), bool)
    for x in (i, j):
        order = np.lexsort((d, x))
        new = np.append(True, x[order][1:] != x[order][:-1])
        first = np.flatnonzero(new)
        rank = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
        kept[order[rank < best]] = True
        full = np.repeat(np.diff(np.append(first, len(x))) > best, np.diff(np.append(first, len(x))))
        more[order[full]] = True
    return i[kept], j[kept], more[kept]


def jaccard_components(
    docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents tied together by links of a shingle Jaccard similarity of ``percent`` per cent or more.

    Columns: the id, ``n_shingles``, ``component_id`` (the smallest id that links
    reach, itself included).  No link between components is missed.

    Documents with one set are one class, known by its smallest id.  A tile is
    a shingle that stands in the prefixes of several classes, one tile for
    those with the same classes; its rows meet in bands of sizes, bitmap
    signatures bound the overlap from above, and sets of the pairs left are
    intersected.  Rows that links have already tied together are not compared
    again: large tiles start with links to one member, those that are left meet
    in cells of two blocks of bounded size, and each round takes more partners
    per row than the one before, until no row has others.

    Null texts and texts without words have size 0 and link with nothing.  Rows
    that repeat an id have their own sizes and share their links.  A null id
    links with nothing.  Ids must be whole numbers.  Other columns are ignored;
    an empty table gives no rows.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must be a whole number, not {kind}")
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    profiled = settle(
        base.mapInArrow(_profiles(size), "id long, n long, k1 long, k2 long, sig binary, shingle long"), "profiles"
    )
    sized = profiled.filter("shingle is null").drop("shingle")
    often = profiled.filter("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("times"))
    # A bounded list; it only orders the prefixes.
    common = often.filter(F.col("times") >= COMMON_FROM).orderBy(F.desc("times"), "shingle").limit(COMMON).collect()
    common = np.sort(np.array([r.shingle for r in common], np.int64).view(np.uint64))
    usable = sized.filter("n > 0 AND id IS NOT NULL")
    classes = settle(
        usable.groupBy("k1", "k2", "n").agg(F.min("id").alias("c"), F.min("sig").alias("sig")), "classes"
    )
    named = base.filter("id IS NOT NULL")
    prefixes = named.mapInArrow(_prefixes(size, percent, common), "shingle long, k1 long, n int")
    dealt = prefixes.repartition("shingle").dropDuplicates(["shingle", "k1"])
    postings = dealt.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("k1").alias("x1"), F.bit_xor(F.xxhash64("k1")).alias("x2"),
        F.min("n").alias("least"), F.max("n").alias("most"),
    )
    # Two sets whose sizes are too far apart can't be linked.
    possible = (F.col("rows") > 1) & ((F.col("rows") > 2) | (F.col("least") * 100 >= F.col("most") * percent))
    shared = settle(
        postings.filter(possible).groupBy("rows", "x1", "x2").agg(F.min("shingle").alias("shingle")).select("shingle", "rows"),
        "shared",
    )
    release(spark)
    # Most members are shared by nobody: a bitmap of fixed size keeps nearly all of them out of the shuffle, the
    # join the rest.
    only = bit_set(shared.select(F.col("shingle").bitwiseAND(F.lit(BITS - 1)).alias("at")))
    prefixes = named.mapInArrow(_prefixes(size, percent, common, only), "shingle long, k1 long, n int")
    seen = settle(prefixes.select("shingle", "k1").join(shared, "shingle").distinct(), "seen")
    rows = settle(seen.join(classes.select("k1", "c", "n"), "k1").select("shingle", "k1", "c", "n", "rows"), "rows")
    discard(shared, seen)
    release(spark)
    comps = settle(_linked_components(base, rows, classes, percent, size), "comps")
    discard(rows)
    tied = classes.join(comps.withColumnRenamed("id", "c"), "c", "left").select(
        "k1", "k2", "n", F.coalesce("component", "c").alias("component")
    )
    tied = settle(tied, "tied")
    discard(classes)
    out = usable.join(tied, ["k1", "k2", "n"]).select("id", "n", "component")
    alone = sized.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component"))
    return out.unionByName(alone).select(
        F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), F.col("component").cast(kind).alias("component_id")
    )


def _linked_components(base: DataFrame, rows: DataFrame, classes: DataFrame, percent: int, size: int) -> DataFrame:
    """(id, component) of the classes that links tie together, found in rounds."""
    spark = rows.sparkSession
    large = rows.filter(F.col("rows") > STAR).select("shingle", "k1", "c", "n")
    zero = F.lit(0).cast("long")
    small = rows.filter(F.col("rows") <= STAR).withColumns({"lo": zero, "hi": zero, "side": F.lit(0), "comp": F.col("c")})
    best = FIRST_BEST
    offered = settle(
        _offers(small, classes, percent, best).unionByName(_stars(large, classes, percent)), "offered"
    )
    # Whoever has a partner by signature has offered one or stands in a large tile, so these are all:
    # the others' rows need not be compared again.
    live = offered.select(F.col("a").alias("c")).union(offered.select(F.col("b").alias("c"))).union(large.select("c"))
    live = settle(live.distinct(), "live")
    sets = settle(_sets_of(base, live.withColumnRenamed("c", "id"), size), "sets")
    rows = settle(rows.join(live, "c", "left_semi"), "live rows")
    release(spark)
    # Rows of large tiles that the stars did not tie are compared next, each with few partners again.
    starred = not large.isEmpty()
    unfinished = False
    links = tested = None
    while True:
        pairs = offered.select("a", "b").distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settle(pairs, "pairs")
        found = settle(_verified(sets, pairs, percent), "links")
        links = found if links is None else settle(links.unionByName(found), "links")
        tested = pairs if tested is None else settle(tested.unionByName(pairs), "tested")
        comps = settle(components(links), "comps")
        unfinished = unfinished or not offered.filter("more").isEmpty()
        discard(offered)
        release(spark)
        if starred:
            again = rows.filter(F.col("rows") > STAR)
        elif unfinished:
            again = rows
            best *= GROWTH
            unfinished = False
        else:
            discard(sets, rows)
            return comps
        starred = False
        cells = _cells(again, comps, percent)
        offered = settle(_offers(cells, classes, percent, best), "offered")
        discard(cells)


def _sets_of(base: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(id, members) of the wanted documents.

    The texts are dealt by id once, however many are wanted.
    """
    texts = base.join(wanted.hint("merge"), "id", "left_semi")
    return texts.mapInArrow(_sets(size), "id long, members array<bigint>").filter(F.size("members") > 0)


def _verified(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach ``percent``.

    Sets are large and pairs may be many, so both are dealt by id whatever their number.
    """
    pairs = pairs.hint("merge")
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("members").alias("one")), "a")
    both = one.hint("merge").join(sets.select(F.col("id").alias("b"), F.col("members").alias("two")), "b")
    linked = both.select("a", "b", "one", "two").mapInArrow(_linked(percent), "a long, b long")
    return linked.distinct()


def kept_documents(
    docs: DataFrame, percent: int = 80, size: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents whose id is the smallest of their component, with the columns of ``docs``."""
    tied = jaccard_components(docs, percent, size, id_col, text_col)
    stay = tied.filter(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias("stay_id")).distinct()
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"))
    stay = settle(stay, "stay")
    return packed.join(stay, F.col("id").eqNullSafe(F.col("stay_id")), "left_semi").select("row.*")
