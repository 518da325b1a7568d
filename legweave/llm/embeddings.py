"""Near-duplicate embeddings by an exact metric range join."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legweave.llm.components import components
from legweave.llm.samples import bounded_sample
from legweave.scratch import discard, settle

# Vectors that a pivot should hold at least, and numbers in all pivots together (16 MB at 8 bytes).
PER_PIVOT, PIVOT_NUMBERS = 2_048, 2_000_000
# Vectors whose distances to all pivots are held at a time.
STEP = 1_024
# Vectors on either side of one tile.
TILE = 2_048
# Distances are compared with this much room, so that rounding hides no partner; the cosine decides.
ROOM = 1e-9


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # keeps squares of tiny and huge numbers finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(embedding: Column, label: Column, vec_id: Column) -> Column:
    """Whether a vector can link: it has an id, a label, finite components and one that isn't zero."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ok = label.isNotNull() & vec_id.isNotNull() & finite & F.exists(embedding, lambda c: c != 0)
    return F.coalesce(ok, F.lit(False))


def _pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Unit pivots of the larger spaces, drawn in the order of a hash; at most PIVOT_NUMBERS numbers.

    There is one for PER_PIVOT vectors, but no more than half the square root of
    a space: then cells grow with it as well, and visitors are not copied to
    more and more small ones.  A space that finds no room for so many has fewer.
    """
    sizes = classes.groupBy("label", "dim").count().filter(F.col("count") >= 2 * PER_PIVOT)
    wanted = F.least(F.ceil(F.col("count") / PER_PIVOT), F.ceil(F.sqrt("count") / 2)).cast("int")
    largest = sizes.select("label", "dim", "count", wanted.alias("k")).orderBy(F.desc("count"), "label", "dim")
    room, chosen = PIVOT_NUMBERS, []
    for r in largest.limit(max(100, PIVOT_NUMBERS // 1_000)).collect():
        k = min(r.k, room // r.dim)
        if k > 1:
            chosen.append((r.label, r.dim, k))
            room -= k * r.dim
    if not chosen:
        return {}
    spark = classes.sparkSession
    label_type = classes.schema["label"].dataType.simpleString()
    spaces = F.broadcast(spark.createDataFrame(chosen, f"label {label_type}, dim int, k int"))  # bounded above
    pool = classes.join(spaces, ["label", "dim"]).withColumn("space", F.struct("label", "dim"))
    most = max(k for _, _, k in chosen)
    drawn = bounded_sample(pool.select("space", "label", "dim", "k", "cid"), "space", "cid", most)
    nth = F.row_number().over(Window.partitionBy("space").orderBy(F.xxhash64("cid"), "cid"))
    drawn = settle(drawn.withColumn("nth", nth).filter("nth <= k").select("cid", "label", "dim"), "drawn")
    picked = classes.join(drawn, ["cid", "label", "dim"], "left_semi").select("label", "dim", "embedding").collect()
    out: dict[tuple, list] = {}
    for r in picked:
        out.setdefault((r.label, r.dim), []).append(r.embedding)
    return {space: _unit(np.array(rows, np.float64)) for space, rows in out.items()}


def _cells(pivots: dict[tuple, np.ndarray], radius: float):
    """Class rows to rows of the cell they live in (``home``) and of each cell whose border is within reach.

    A vector lives with its nearest pivot.  Between two pivots the border is the
    plane midway; by the triangle inequality a partner beyond it is at least as
    far as the plane, so only vectors within the radius of it are copied over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces: dict[tuple, list[int]] = {}
            for n, space in enumerate(zip(batch["label"].to_pylist(), batch["dim"].to_pylist(), strict=True)):
                spaces.setdefault(space, []).append(n)
            rows, cells, homes = [], [], []
            for space, members in spaces.items():
                at = np.array(members)
                centres = pivots.get(space)
                if centres is None:
                    rows.append(at)
                    cells.append(np.zeros(len(at), np.int32))
                    homes.append(np.ones(len(at), bool))
                    continue
                x = _unit(_matrix(batch["embedding"].take(pa.array(at)), space[1]))
                for lo in range(0, len(x), STEP):
                    squares = np.maximum(2 - 2 * (x[lo : lo + STEP] @ centres.T), 0)
                    some = np.arange(len(squares))
                    home = squares.argmin(1)
                    near, of = np.unique(home, return_inverse=True)
                    apart = np.sqrt(np.maximum(2 - 2 * (centres[near] @ centres.T), 0))[of]
                    here = squares - squares[some, home][:, None] <= 2 * apart * radius + ROOM
                    here[some, home] = True
                    who, cell = np.nonzero(here)
                    rows.append(at[lo + who])
                    cells.append(cell.astype(np.int32))
                    homes.append(cell == home[who])
            if not rows:
                continue
            taken = batch.take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(np.concatenate(cells)), pa.array(np.concatenate(homes))],
                [*taken.schema.names, "cell", "home"],
            )

    return run


def _tile(threshold: float):
    """Links between the home and the visiting classes of one tile: their weights per home class, and the
    smallest class that each is tied to within the tile."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table["is_home"].to_numpy()
        dim = table["dim"][0].as_py()
        x = _unit(_matrix(table["embedding"].chunk(0), dim))
        ids, weights = table["cid"].to_numpy(), table["weight"].to_numpy()
        a, b = np.flatnonzero(side), np.flatnonzero(~side)
        linked = x[a] @ x[b].T >= threshold
        linked &= ids[a][:, None] != ids[b][None, :]
        counts = linked @ weights[b]
        root_a, root_b = ids[a].copy(), ids[b].copy()
        last = np.iinfo(np.int64).max
        while linked.size:
            new_a = np.minimum(root_a, np.where(linked, root_b, last).min(1))
            new_b = np.minimum(root_b, np.where(linked, new_a[:, None], last).min(0))
            if (new_a == root_a).all() and (new_b == root_b).all():
                break
            root_a, root_b = new_a, new_b
        tied = root_b != ids[b]
        return pa.table(
            {
                "cid": np.concatenate([ids[a], ids[b][tied]]),
                "links": np.concatenate([counts, np.zeros(tied.sum(), np.int64)]).astype(np.int64),
                "root": np.concatenate([root_a, root_b[tied]]),
            }
        )

    return run


def near_embeddings(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Links between vectors of one label with a cosine of ``threshold`` or more, and what they tie together.

    Columns: the id, ``n_links`` (other vectors linked directly),
    ``component_id`` (the smallest id that links reach, itself included),
    ``kept`` (it is that id).  The search is exact.

    Equal vectors of a label are one class with a weight and a number of its
    own, so ids may repeat across vectors and labels.  The classes of a large label are dealt to cells around pivots, each visiting the cells whose
    border is within reach; a cell's residents meet its residents and visitors
    in tiles of bounded size.  The cosine is computed in double precision.

    Vectors without id or label, null or empty ones, zero ones, and those with a
    null or non-finite component link with nothing; so do vectors of different
    lengths.  Rows that repeat an id are vectors of their own.  Other columns
    are ignored; an empty table gives no rows.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    radius = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding")
    ).withColumn("ok", usable(F.col("embedding"), F.col("label"), F.col("id")))
    good = rows.filter("ok").select("id", "label", "embedding")
    classes = settle(
        good.groupBy("label", "embedding")
        .agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("weight"))
        # The numbers are written with the classes, so they stay.
        .withColumns({"dim": F.size("embedding"), "cid": F.monotonically_increasing_id()}),
        "classes",
    )
    dealt = classes.drop("low")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    placed = settle(dealt.mapInArrow(_cells(_pivots(dealt), radius), f"{kind}, cell int, home boolean"), "placed")
    space = ["label", "dim", "cell"]
    parts = settle(
        placed.groupBy(*space).agg(
            F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("visits"),
            F.ceil(F.count_if("home") / TILE).cast("int").alias("homes"),
        ).filter("homes > 0"),
        "parts",
    )
    sized = placed.join(parts, space)
    draw = F.pmod(F.xxhash64("cid", F.lit("tile")), F.lit(1 << 30))
    own = sized.filter("home").select(
        *space, (draw % F.col("homes")).cast("int").alias("row"), "visits", "cid", "weight", "embedding"
    )
    own = own.withColumn("col", F.explode(F.sequence(F.lit(0), F.col("visits") - 1))).withColumn("is_home", F.lit(True))
    seen = sized.select(
        *space, (draw % F.col("visits")).cast("int").alias("col"), "homes", "cid", "weight", "embedding"
    )
    seen = seen.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("homes") - 1))).withColumn("is_home", F.lit(False))
    tiles = own.drop("visits").unionByName(seen.drop("homes"))
    found = settle(
        tiles.groupBy(*space, "row", "col").applyInArrow(_tile(threshold), "cid long, links long, root long"), "found"
    )
    discard(placed, parts)
    tied = components(found.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"))
    joined = settle(classes.join(tied.withColumnRenamed("id", "cid"), "cid", "left"), "joined")
    lowest = joined.filter("component IS NOT NULL").groupBy("component").agg(F.min("low").alias("component_low"))
    merged = settle(
        joined.join(counted, "cid", "left")
        .join(lowest, "component", "left")
        .select(
            F.col("label").alias("c_label"),
            F.col("embedding").alias("c_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_low", "low").alias("component_id"),
        ),
        "merged",
    )
    same = (good["label"] == merged["c_label"]) & (good["embedding"] == merged["c_embedding"])
    linked = good.join(merged, same).select("id", "n_links", "component_id")
    alone = rows.filter("not ok").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
