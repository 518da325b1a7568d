"""Removal of repeated substrings: merged Burrows-Wheeler transforms of the places that may repeat."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legweave.llm.batches import BLOCK_BYTES, blocks, ragged, utf8
from legweave.llm.ordered import running_totals
from legweave.scratch import discard, release, settle

# Bytes of the grams that deal windows to classes at first; classes too large are dealt again by longer ones.
FIRST_GRAM = 32
# Fragments that a class may have, fragments of one merge, and shards whose transforms it merges.
CLASS_LIMIT, MERGE_FRAGMENTS, SHARDS = 8_192, 300, 4
# Texts that share an id are numbered in the upper bits of a position; a text is shorter than 2 to the 31 bytes.
ROW_SHIFT = 31

_random = np.random.default_rng(9_173)
GEAR = _random.integers(1 << 32, size=256, dtype=np.uint32)
MIXERS = _random.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# Dealing windows to classes


def _gram_order(data: np.ndarray, gram: int) -> np.ndarray:
    """A 32-bit hash of the ``gram`` bytes from each place on; what passes the end is 0-filled."""
    power, width, rest, done = GEAR[data], 1, gram, 0
    out = np.zeros(len(data), np.uint32)
    factor = np.uint32(0x9E3779B1)
    while True:  # adds runs of 1, 2, 4, .. bytes as the bits of ``gram`` ask for them
        if rest & 1:
            out *= factor
            out[: len(out) - done] += power[done:]
            done += width
        rest >>= 1
        if not rest:
            break
        longer = power * factor
        longer[:-width] += power[width:]
        power, width = longer, 2 * width
        factor = np.uint32(int(factor) * int(factor) & 0xFFFFFFFF)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    return out


def runs(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring windows of ``length`` bytes whose smallest gram stands at one place: first window, number of
    windows, and that place.  Windows never cross documents; equal windows have the same gram at the same offset."""
    places = len(data) - length + 1
    none = np.empty(0, np.int64)
    if places <= 0:
        return none, none, none
    inside = np.ones(places, bool)
    tails = ragged(np.maximum(starts[1:] - length + 1, starts[:-1]), np.minimum(np.diff(starts), length - 1))
    inside[tails[tails < places]] = False
    order = _gram_order(data, gram)
    # The place rides in the lower bits, so that the leftmost of equal grams is the smallest.
    least = (order.astype(np.uint64) << np.uint64(32)) | np.arange(len(data), dtype=np.uint64)
    reach, width = length - gram + 1, 1
    while width < reach:
        step = min(width, reach - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    window = np.flatnonzero(inside)
    place = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    if not len(window):
        return none, none, none
    new = np.append(True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1))
    first = np.flatnonzero(new)
    return window[first], np.diff(np.append(first, len(window))), place[first]


def class_hash(data: np.ndarray, places: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at each place."""
    out = np.zeros(len(places), np.uint64)
    for k in range(gram):
        out = (out ^ data[places + k]) * MIXERS[k % 64]
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _fingerprints(data: np.ndarray, first: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    view = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_64_intdigest
    spans = zip(first.tolist(), (first + count + length - 1).tolist(), strict=True)
    return np.array([digest(view[a:b]) for a, b in spans], np.uint64).view(np.int64)


def parts(starts: np.ndarray, length: int, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """Blocks as rows lo to hi and bytes a to b; a longer text comes in parts, each of its windows in one of them."""
    for lo, hi in blocks(starts, limit):
        a, b = int(starts[lo]), int(starts[hi])
        if hi - lo > 1 or b - a <= limit:
            yield lo, hi, a, b
            continue
        for at in range(a, max(b - length + 1, a + 1), limit):
            yield lo, hi, at, min(at + limit + length - 1, b)


def _cut(length: int, gram: int, what: str, limit: int):
    """Arrow batches (d, p, text or bytes): a text's runs as hashes and counts (``count``), as rows of class,
    fingerprint, place and number of windows (``runs``), or as such rows with their bytes (``pieces``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("body")
            data, starts = utf8(column) if what != "pieces" else _binary(column)
            for lo, hi, a, b in parts(starts, length, limit):
                part, at = data[a:b], np.clip(starts[lo : hi + 1], a, b) - a
                first, count, place = runs(part, at, length, gram)
                if not len(first):
                    continue
                hashes = class_hash(part, place, gram)
                if what == "count":
                    seen, times = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(times)], ["class", "times"])
                    continue
                row = np.searchsorted(at, first, "right") - 1
                columns = {
                    "class": pa.array(hashes),
                    "print": pa.array(_fingerprints(part, first, count, length)),
                    "d": batch.column("d").slice(lo, hi - lo).take(pa.array(row)),
                    "p": pc.add(batch.column("p").slice(lo, hi - lo).take(pa.array(row)), pa.array(first + a - starts[lo + row])),
                    "n": pa.array(count.astype(np.int32)),
                }
                if what == "pieces":
                    columns["body"] = _slices(part, first, count + length - 1)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.append(0, np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))).astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8), sizes


def _slices(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
    flat = memoryview(np.ascontiguousarray(data))
    return pa.array([bytes(flat[a : a + n]) for a, n in zip(first.tolist(), sizes.tolist(), strict=True)], pa.binary())


# Merging transforms


def _step(length: int, size: int) -> int:
    """Bytes that one symbol of the transforms holds: the most that divide a window, up to 10.

    Up to 5 where there are so many bytes that the ranks of longer ones might need more than 16 bits.
    """
    return next(t for t in range(10 if size <= 1 << 16 else 5, 0, -1) if length % t == 0)


def _small(ranks: np.ndarray) -> np.ndarray:
    """Dense ranks in the narrowest type: sorting 16-bit numbers takes one counting pass."""
    top = int(ranks.max()) if len(ranks) else 0
    return ranks.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32)


def shard_transform(symbols: np.ndarray, before: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """A shard's rotations in the order of their first ``rounds`` symbols, and its Burrows-Wheeler transform.

    ``symbols[i]`` starts rotation i, and ``before[i]`` is the rotation one symbol earlier.
    """
    order = np.arange(len(symbols))
    for _ in range(rounds):
        earlier = before[order]
        order = earlier[np.argsort(symbols[earlier], kind="stable")]
    return order, symbols[before[order]]


def interleave(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Which shard each rotation of the merged order comes from, and its block of rotations alike in ``rounds``
    symbols.

    The interleave after k rounds orders by k symbols.  A round reads the
    shards' transforms through it and deals them by symbol, keeping their
    order; a border between blocks stays one, and new ones come up where the
    symbol or the block read from changes.  No suffix is compared or sorted.
    """
    joined = np.concatenate(transforms)
    sizes = [len(t) for t in transforms]
    source = _small(np.repeat(np.arange(len(sizes)), sizes))
    block = np.zeros(len(joined), np.int64)
    read = np.empty_like(joined)
    for _ in range(rounds):
        read[np.argsort(source, kind="stable")] = joined
        dealt = np.argsort(read, kind="stable")
        symbol, block = read[dealt], block[dealt]
        source = source[dealt]
        borders = np.append(False, (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))
        block = np.cumsum(borders)
    return source, block


def later_windows(bodies: list[bytes], length: int) -> np.ndarray:
    """Where in the bodies, end to end, a window starts that equals one starting before it.

    The bodies' rotations are cut into shards; a rotation that starts a whole
    window is compared within its body only.  Bodies are in the order in which
    windows count as earlier.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    step = _step(length, int(sizes.sum()))
    rounds = length // step
    ends = np.cumsum(sizes)
    starts = ends - sizes
    data = np.frombuffer(b"".join(bodies), np.uint8)
    base, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    place = np.arange(len(data)) - base
    # Symbols are dense ranks of their bytes: of the first up to five, then of that rank and the bytes after.
    gram = np.zeros(len(data), np.uint64)
    for k in range(step):
        if k == 5:
            gram = np.unique(gram, return_inverse=True)[1].astype(np.uint64)
        gram = (gram << np.uint64(8)) | data[base + (place + k) % size]
    symbols = _small(np.unique(gram, return_inverse=True)[1])
    before = base + (place - step) % size
    cuts = starts[np.linspace(0, len(bodies), SHARDS + 1).astype(int)[:-1]]
    cuts = np.unique(np.append(cuts, len(data)))
    orders, transforms = [], []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        order, transform = shard_transform(symbols[a:b], before[a:b] - a, rounds)
        orders.append(order + a)
        transforms.append(transform)
    source, block = interleave(transforms, rounds)
    rotation = np.empty(len(data), np.int64)
    rotation[np.argsort(source, kind="stable")] = np.concatenate(orders)
    whole = place[rotation] + length <= size[rotation]
    rotation, block = rotation[whole], block[whole]
    first = np.full(int(block.max()) + 1 if len(block) else 0, len(data))
    np.minimum.at(first, block, rotation)
    return np.sort(rotation[rotation != first[block]])


def _merge(length: int):
    """One bucket of fragments (d, p, n, body): the spans of windows that an earlier fragment's or place's equal."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("d", "ascending"), ("p", "ascending")])
        bodies = table["body"].to_pylist()
        found = later_windows(bodies, length)
        sizes = np.array([len(b) for b in bodies], np.int64)
        starts = np.cumsum(sizes) - sizes
        row = np.searchsorted(starts, found, "right") - 1
        first = np.flatnonzero(np.append(True, (np.diff(found) != 1) | (np.diff(row) != 0))) if len(found) else found
        last = np.append(first[1:], len(found)) - 1 if len(found) else found
        d, p = table["d"].to_numpy(), table["p"].to_numpy()
        own = row[first]
        return pa.table(
            {
                "d": d[own],
                "lo": p[own] + found[first] - starts[own],
                "hi": p[own] + found[last] - starts[own] + length,
            }
        )

    return run


# The operator


def _split_by_first(pieces: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """Spans of the pieces that are not the first of their class and fingerprint: all their windows came before."""
    keyed = pieces.join(firsts.select("class", "print", F.col("first.d").alias("fd"), F.col("first.p").alias("fp")), ["class", "print"])
    later = keyed.filter((F.col("d") > F.col("fd")) | ((F.col("d") == F.col("fd")) & (F.col("p") > F.col("fp"))))
    return later.select("d", F.col("p").alias("lo"), (F.col("p") + F.col("n") + length - 1).alias("hi"))


def repeated_spans(
    texts: DataFrame, length: int, class_limit: int = CLASS_LIMIT, part_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Spans (d, lo, hi) of texts (d, p, body) covered by windows of ``length`` bytes that also start earlier.

    No (d, p) may come twice.

    Windows are dealt to classes by their smallest gram.  Classes seen once
    hold nothing.  In the others, runs of windows with equal fingerprints of
    class and bytes are settled by the earliest; what is left of classes with
    several variants, a few per cent of the bytes, goes with its bytes into
    buckets, whose transforms are merged.  A class of more than ``class_limit``
    variants is dealt again by longer grams, at last by whole windows.
    """
    spark = texts.sparkSession
    gram = min(FIRST_GRAM, length)
    counted = texts.mapInArrow(_cut(length, gram, "count", part_bytes), "class long, times long")
    repeated = settle(counted.groupBy("class").agg(F.sum("times").alias("times")).filter("times > 1").select("class"), "repeated")
    release(spark)
    cut = texts.mapInArrow(_cut(length, gram, "runs", part_bytes), "class long, print long, d long, p long, n int")
    seen = settle(cut.join(repeated, "class"), "seen")
    discard(repeated)
    release(spark)
    firsts = settle(
        seen.groupBy("class", "print").agg(F.min(F.struct("d", "p", "n")).alias("first")), "firsts"
    )
    spans = settle(_split_by_first(seen, firsts, length), "spans")
    discard(seen)
    mixed = firsts.groupBy("class").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
    mixed = settle(mixed, "mixed")
    wanted = firsts.join(mixed, "class").select("class", "variants", "first.d", "first.p", "first.n")
    by_text = wanted.groupBy("d", F.shiftright("p", ROW_SHIFT).alias("row")).agg(
        F.collect_list(F.struct("class", "variants", "p", "n")).alias("places")
    )
    rows = texts.withColumn("row", F.shiftright("p", ROW_SHIFT)).select("d", "row", "body")
    pieces = settle(
        rows.join(by_text, ["d", "row"]).mapInArrow(
            _fetch(length), "class long, variants long, d long, p long, n int, body binary"
        ),
        "pieces",
    )
    discard(firsts, mixed)
    release(spark)
    found = [spans]
    while not pieces.isEmpty():
        small = pieces.filter(F.col("variants") <= class_limit)
        buckets = max(1, small.count() // MERGE_FRAGMENTS)
        dealt = small.withColumn("bucket", F.pmod(F.xxhash64("class"), F.lit(buckets)))
        merged = dealt.select("bucket", "d", "p", "body").groupBy("bucket").applyInArrow(
            _merge(length), "d long, lo long, hi long"
        )
        found.append(settle(merged, "spans"))
        large = pieces.filter(F.col("variants") > class_limit)
        if large.isEmpty():
            break
        gram = (gram + length + 1) // 2
        cut = settle(
            large.select("d", "p", "body").mapInArrow(
                _cut(length, gram, "pieces", part_bytes), "class long, print long, d long, p long, n int, body binary"
            ),
            "cut",
        )
        firsts = settle(cut.groupBy("class", "print").agg(F.min(F.struct("d", "p", "n", "body")).alias("first")), "firsts")
        found.append(settle(_split_by_first(cut, firsts, length), "spans"))
        mixed = firsts.groupBy("class").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1")
        rest = settle(firsts.join(settle(mixed, "mixed"), "class").select("class", "variants", "first.*"), "pieces")
        discard(pieces, cut, firsts)
        pieces = rest
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _fetch(length: int):
    """Rows (d, row, body, places): each place's class, variants, position, number of windows, and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("body"))
            lists = batch.column("places")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            places = lists.flatten()
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            p, n = places.field("p"), places.field("n")
            at = (p.to_numpy() & ((1 << ROW_SHIFT) - 1)) + starts[owner]
            body = _slices(data, at, n.to_numpy() + length - 1)
            yield pa.RecordBatch.from_arrays(
                [places.field("class"), places.field("variants"), batch.column("d").take(pa.array(owner)), p, n, body],
                ["class", "variants", "d", "p", "n", "body"],
            )

    return run


def _numbered(texts: DataFrame) -> DataFrame:
    """Distinct (d, h) with ``row``: the place of h in its d from 0, counted over ranges, so no d is gathered."""
    ranked = running_totals(texts.withColumn("one", F.lit(1).cast("long")), ["d", "h"], ["one"])
    first = ranked.groupBy("d").agg(F.min("before_one").alias("first"))
    row = F.col("before_one") - F.col("first")
    most = F.lit(1 << (63 - ROW_SHIFT))
    held = F.when(row < most, row).otherwise(F.raise_error(F.lit("too many texts share one id")).cast("long"))
    return ranked.join(first, "d").select("d", "h", held.alias("row"))


def _cleaned(with_text: bool):
    """Rows (.., body, places): the digest columns of the text without the spans of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept_text": []}
            data, starts = utf8(batch.column("body"))
            view = memoryview(np.ascontiguousarray(data))
            for r, places in enumerate(batch.column("places").to_pylist()):
                a, b = int(starts[r]), int(starts[r + 1])
                kept, at, spans, removed = [], a, 0, 0
                end = -1
                for span in sorted((x["lo"], x["hi"]) for x in places or ()):
                    lo, hi = a + span[0], a + span[1]
                    if lo > end:
                        spans += 1
                        kept.append(view[at:lo])
                    removed += max(0, hi - max(lo, end))
                    end = max(end, hi)
                    at = end
                kept.append(view[at:b])
                bare = b"".join(kept)
                out["n_bytes"].append(b - a)
                out["n_removed"].append(removed)
                out["n_spans"].append(spans)
                out["kept_sha256"].append(hashlib.sha256(bare).hexdigest())
                if with_text:
                    out["kept_text"].append(bare.decode("utf-8", "replace"))
            names = [*list(out)[:4], *(["kept_text"] if with_text else [])]
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            arrays = [pa.array(out[n], k) for n, k in zip(names, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *arrays], ["id", *names])

    return run


def remove_repeats(
    docs: DataFrame,
    length: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
    class_limit: int = CLASS_LIMIT,
    part_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each document without the bytes of ``length``-byte strings that also start earlier.

    Columns: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256`` and, with ``with_text``, ``kept_text`` (broken signs
    at the cuts become U+FFFD).  Earlier is a smaller id, or an earlier place in
    the same document; overlaps count, and strings are judged on the input.

    Windows of texts longer than ``part_bytes`` are dealt in parts of that size.
    Null texts count as empty.  A null id comes before all others.  Rows that
    repeat an id are ordered by a hash of their text; rows alike in both are one
    document and get the same result; 2 to the 32 texts may share an id.  Ids must be whole numbers.  Other columns
    are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} must be a whole number, not {kind}")
    base = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("d"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"),
    )
    hashed = base.withColumn("h", F.xxhash64("body"))
    row = F.lit(0).cast("long")
    shared = settle(hashed.groupBy("d").count().filter("count > 1").select("d"), "shared")
    if shared.isEmpty():
        texts = hashed.select("id", "d", F.lit(0).cast("long").alias("p"), "body")
        once = texts.select("d", "p", "body")
    else:
        numbered = settle(_numbered(hashed.select("d", "h").join(shared, "d", "left_semi").distinct()), "numbered")
        row = F.shiftleft(F.coalesce("row", F.lit(0).cast("long")), ROW_SHIFT)
        texts = hashed.join(numbered, ["d", "h"], "left").select("id", "d", row.alias("p"), "body")
        # Rows alike in id and text are one document: its places are sought once.
        once = settle(texts.select("d", "p", "body").dropDuplicates(["d", "p"]), "once")
    spans = repeated_spans(once, length, class_limit, part_bytes)
    mask = F.lit((1 << ROW_SHIFT) - 1)
    places = (
        spans.select("d", F.shiftright("lo", ROW_SHIFT).alias("row"), F.col("lo").bitwiseAND(mask).alias("lo"), F.col("hi").bitwiseAND(mask).alias("hi"))
        .groupBy("d", "row")
        .agg(F.collect_list(F.struct("lo", "hi")).alias("places"))
    )
    joined = texts.withColumn("row", F.shiftright("p", ROW_SHIFT)).join(settle(places, "places"), ["d", "row"], "left")
    extra = ", kept_text string" if with_text else ""
    cleaned = joined.select("id", "body", "places").mapInArrow(
        _cleaned(with_text), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{extra}"
    )
    return cleaned.withColumnRenamed("id", id_col)
