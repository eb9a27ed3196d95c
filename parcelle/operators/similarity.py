"""Nearest territories in standardised score space."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions.order_stats import fill_with_median
from parcelle.functions.scores import steady_round
from parcelle.operators.dedup import first_per_key
from parcelle.operators.filters import drop_all_null
from parcelle.params import SCORE_COLUMNS
from parcelle.session import fan_out, stored

# Reference points of the all-keys search: the square root of the number of rows, up to this many. They and a
# few distances for each are all that is broadcast.
MOST_PIVOTS = 256
# Members of a cell, and queries, that one task compares at once; distances it holds at once.
BLOCK = 16_384
HELD = 1 << 21


def _scales(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float]]:
    """Mean and population deviation (1 if constant) of each column, from one aggregate row."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def _scaled(column: Column, mean: float | None, spread: float) -> Column:
    return (column - F.lit(mean).cast("double")) / F.lit(spread)


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean, unit population deviation; a constant column is only centred."""
    scales = _scales(df, columns)
    return df.withColumns({c: _scaled(F.col(c), *scales[c]) for c in columns})


def _known(df: DataFrame, used: Sequence[str], carried: Sequence[str], key: str) -> DataFrame:
    """One row per key with all scores: rows without any go, gaps take the median."""
    kept = drop_all_null(df, used)
    # one aggregate row tells whether there are gaps; without any no median is needed
    values = F.array(*[F.col(c).cast("double") for c in used])
    gaps = kept.agg(F.max(F.exists(values, lambda x: x.isNull() | F.isnan(x)))).first()[0]
    return first_per_key(
        (fill_with_median(kept, used) if gaps else kept).select(key, *carried, *used),
        [key],
        [F.col(c).asc_nulls_last() for c in used],
    )


def similar(
    df: DataFrame,
    code: str,
    top: int = 5,
    columns: Sequence[str] = SCORE_COLUMNS,
    key: str = "code_commune",
) -> DataFrame:
    """The ``top`` nearest territories with a 0-100 similarity and their score columns.

    Empty when the code is unknown or fewer than two score columns exist. The
    target is one row found by key; the search is one scan with a top-k, so
    neither pairs nor a sort of all rows arise.
    """
    used = [c for c in columns if c in df.columns]
    carried = [c for c in ("nom_commune", "avg_price_m2") if c in df.columns]
    if len(used) < 2:
        return df.select(key).limit(0)
    known = _known(df, used, carried, key)
    target = known.where(F.col(key) == code).first()
    if target is None:
        return known.select(key, *carried, F.lit(0.0).alias("similarity"), F.lit(0.0).alias("distance"), *used).limit(0)
    scales = _scales(known, used)
    # vectors as arrays: a sum over many columns makes the optimizer infer a constraint for each of them
    mine = F.array(*[_scaled(F.col(c).cast("double"), *scales[c]) for c in used])
    its = F.array(*[_scaled(F.lit(target[c]).cast("double"), *scales[c]) for c in used])
    squares = F.aggregate(F.zip_with(mine, its, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    ranked = (
        known.withColumn("distance", F.sqrt(squares))
        .where(F.col("distance").isNotNull())
        .orderBy("distance", key)
        .limit(top + 1)
    )
    # At most top + 1 rows are left here.
    farthest = F.max("distance").over(Window.partitionBy(F.lit(0)))
    unit = F.when(farthest == 0, 1.0).otherwise(farthest)
    return (
        ranked.withColumn("similarity", steady_round((1 - F.col("distance") / unit) * 100, 0))
        .where(F.col(key) != code)
        .orderBy("distance", key)
        .limit(top)
        .select(key, *carried, "similarity", "distance", *used)
    )


def _distance(x: Column, y: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, d: s + d))


def _nearest(pairs: DataFrame, count: int) -> DataFrame:
    """The first ``count`` neighbours of each query by (distance, key)."""
    order = Window.partitionBy("query").orderBy("distance", "neighbour")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column as one matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows, summed up in the order of the columns like ``_distance``."""
    return np.sqrt(np.cumsum((x - y) ** 2, axis=-1)[..., -1])


def _placed(pivots: list, codes: list) -> Callable:
    """The nearest pivot of each member and its distance."""
    centres = np.array(pivots, dtype=float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("v"))
            away, cell = np.empty(len(vectors)), np.empty(len(vectors), dtype=np.int64)
            step = max(1, HELD // centres.size)
            for i in range(0, len(vectors), step):
                far = _apart(vectors[i : i + step, None, :], centres[None, :, :])
                cell[i : i + step] = far.argmin(1)
                away[i : i + step] = far.min(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("neighbour"), batch.column("v"), pa.array(away), pa.array(codes).take(pa.array(cell))],
                names=["neighbour", "v", "away", "cell"],
            )

    return run


def _met(count: int) -> Callable:
    """The first ``count`` members of a block by (distance, key) for each query of a block, within its bound.

    A matrix product finds those that may be among them, with room for its rounding; their distances are then summed up exactly.
    """

    def run(asked: pa.Table, members: pa.Table) -> pa.Table:
        kept = []
        if asked.num_rows and members.num_rows:
            v, w = _matrix(asked.column("v")), _matrix(members.column("w"))
            vv, ww = (v * v).sum(1), (w * w).sum(1)
            room = 1e-11 * (vv.max() + ww.max()) + 1e-18
            bound, keys = asked.column("bound").to_numpy() ** 2, members.column("neighbour").combine_chunks()
            step = max(1, HELD // len(w))
            for i in range(0, len(v), step):
                squares = vv[i : i + step, None] + ww - 2 * (v[i : i + step] @ w.T)
                last = np.partition(squares, min(count, len(w)) - 1, axis=1)[:, min(count, len(w)) - 1]
                # written so that values that are not numbers stay
                q, m = np.nonzero(~(squares > (np.fmin(last, bound[i : i + step]) + room)[:, None]))
                distance = np.concatenate(
                    [_apart(v[i + q[k : k + HELD // 64]], w[m[k : k + HELD // 64]]) for k in range(0, len(q), HELD // 64)] or [np.zeros(0)]
                )
                rank = pc.rank(keys.take(pa.array(m)), null_placement="at_start", tiebreaker="dense").to_numpy()
                order = np.lexsort((rank, distance, q))
                starts = np.searchsorted(q[order], q[order])
                order = order[np.arange(len(order)) - starts < count]
                kept.append((i + q[order], m[order], distance[order]))
        q, m, distance = (np.concatenate(part) for part in zip(*kept)) if kept else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        return pa.table({"query": asked.column("query").take(pa.array(q)), "neighbour": members.column("neighbour").take(pa.array(m)),
                         "distance": pa.array(distance)})

    return run


def similar_all(
    df: DataFrame,
    top: int = 5,
    columns: Sequence[str] = SCORE_COLUMNS,
    key: str = "code_commune",
    queries: Column | None = None,
) -> DataFrame:
    """``similar`` for all keys, or those that meet ``queries``: ``(key, place, neighbour, similarity, distance)``.

    Exact. Rows belong to the nearest of some pivots. A query's distances to the pivots, the cells' radii and the distances of
    each cell's innermost members bound the distance of its last neighbour; its own cell is searched first and lowers the
    bound; the triangle inequality then rules out whole cells, and the others are compared in blocks of ``BLOCK`` members and as
    many queries, where only those within the bound and among the block's first ones are left.
    Of equal vectors only the ``top + 2`` least keys can be anybody's neighbour, so frequent vectors don't multiply.
    Empty with fewer than two score columns; a key that is alone has no row.
    """
    used = [c for c in columns if c in df.columns]
    schema = f"{key} string, place int, neighbour string, similarity double, distance double"
    if len(used) < 2:
        return df.sparkSession.createDataFrame([], schema)
    known = stored(_known(df, used, [], key), "known-scores")
    scales = _scales(known, used)
    vector = F.array(*[_scaled(F.col(c).cast("double"), *scales[c]) for c in used])
    asked = queries if queries is not None else F.lit(True)
    points = stored(known.select(F.col(key).alias("neighbour"), vector.alias("v"), asked.alias("asked")), "score-vectors")
    count = top + 1
    rows = points.count()
    first = F.row_number().over(Window.partitionBy("v").orderBy("neighbour"))
    members = points.select("neighbour", "v").withColumn("copy", first).where(F.col("copy") <= count + 1).drop("copy")
    wanted = min(MOST_PIVOTS, max(1, int(rows**0.5)))
    # one row of at most MOST_PIVOTS vectors
    pivots = members.orderBy(F.xxhash64("neighbour"), "neighbour").limit(wanted).agg(
        F.collect_list(F.struct(F.col("neighbour").alias("cell"), "v")).alias("pivots")
    )
    pivots = stored(pivots, "pivots")
    away = F.transform("pivots", lambda p: F.struct(_distance(F.col("v"), p.v).alias("away"), p.cell.alias("cell")))
    centres = pivots.first().pivots
    placed = members.select("neighbour", "v")
    if centres:
        placed = placed.mapInArrow(
            _placed([c.v for c in centres], [c.cell for c in centres]), "neighbour string, v array<double>, away double, cell string"
        )
    else:
        placed = placed.withColumns({"away": F.lit(0.0), "cell": F.lit("")})
    placed = stored(placed, "placed-vectors")
    inner = placed.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("away"))).where(F.col("r") <= count)
    reach = placed.groupBy("cell").agg(F.max("away").alias("radius"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    bounds = inner.groupBy("cell").agg(F.array_sort(F.collect_list("away")).alias("innermost")).join(reach, "cell").agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("radius", "innermost", "parts")))).alias("bounds")
    )
    queried = points.where("asked").select(F.col("neighbour").alias("query"), "v")
    cells = F.filter(
        F.transform(away, lambda a: F.struct(a.away.alias("away"), a.cell.alias("cell"), F.try_element_at("bounds", a.cell).alias("b"))),
        lambda c: c.b.isNotNull(),
    )
    known_bounds = F.array_sort(F.flatten(F.transform("cells", lambda c: F.transform(c.b.innermost, lambda d: c.away + d))))
    # bounds are compared with room for rounding
    slack = lambda bound: bound * (1 + 1e-9) + 1e-9
    started = stored(
        queried.crossJoin(F.broadcast(pivots)).crossJoin(F.broadcast(bounds)).withColumn("cells", cells)
        .select("query", "v", F.array_min(F.transform("cells", lambda c: F.struct(c.away, c.cell))).getField("cell").alias("own"), "cells",
                F.coalesce(F.get(known_bounds, F.lit(count - 1)), F.lit(float("inf"))).alias("bound")),
        "asked-vectors",
    )
    blocks = F.lit(-(-max(1, started.count()) // BLOCK))
    theirs = placed.join(reach.select("cell", "parts"), "cell").select(
        "cell", F.pmod(F.xxhash64("neighbour"), "parts").cast("int").alias("part"), "neighbour", F.col("v").alias("w"),
        F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
    )
    block_of = ["cell", "part", "block"]

    def searched(asked_cells: DataFrame) -> DataFrame:
        parts = asked_cells.select(
            "query", "v", slack(F.col("bound")).alias("bound"), "cell", F.pmod(F.xxhash64("query"), blocks).cast("int").alias("block"),
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        )
        return fan_out(parts, *block_of).groupBy(*block_of).cogroup(fan_out(theirs, *block_of).groupBy(*block_of)).applyInArrow(
            _met(count), "query string, neighbour string, distance double"
        )

    cell_rows = started.select("query", "v", "own", "bound", F.explode("cells").alias("c")).select(
        "query", "v", "own", "bound", "c.cell", "c.away", F.col("c.b.radius").alias("radius"), F.col("c.b.parts").alias("parts")
    )
    own = stored(_nearest(searched(cell_rows.where("cell = own")), count), "own-cell")
    lowered = own.where(F.col("place") == count).select("query", F.col("distance").alias("lower"))
    others = cell_rows.where("cell <> own").join(lowered, "query", "left").withColumn(
        "bound", F.least("bound", F.coalesce("lower", "bound"))
    ).where(F.col("away") - F.col("radius") <= slack(F.col("bound")))
    found = _nearest(own.drop("place").unionByName(searched(others)), count)
    farthest = F.max("distance").over(Window.partitionBy("query"))
    unit = F.when(farthest == 0, 1.0).otherwise(farthest)
    placed_again = Window.partitionBy("query").orderBy("place")
    return (
        found.withColumn("similarity", steady_round((1 - F.col("distance") / unit) * 100, 0))
        .where("query <> neighbour").withColumn("place", F.row_number().over(placed_again)).where(F.col("place") <= top)
        .select(F.col("query").alias(key), "place", "neighbour", "similarity", "distance")
    )
