"""Grid join, nearest centroid and bounding boxes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.operators.columns import computed_once
from parcelle.session import fan_out, stored

GRID_DIGITS = 2
# A cell is 360 / 2^19 degrees wide at level 0 and twice as wide at each next level, so that four cells hold
# everything at the last one.
LEVELS = 20
CELL = 360.0 / 2 ** (LEVELS - 1)
# The search ends at the widest level where a centroid shares its cell with one other on average, as the centroids see
# it (a dense cluster pulls this down), and begins at the narrowest one where a group has at most ROOTS cells on average.
CROWD, ROOTS = 2.0, 16
# A cell with more points than this is split.
HOT_CELL = 100_000
HOT_SALTS = 64
# More centroids than this are not listed for a point cell; its places meet them as rows.
LONG_LIST = 1_024


def grid_counts(points: DataFrame, centroids: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
    """Points per commune by equal rounded coordinates.

    A point counts for every commune of its cell, as the rule asks. Points are
    counted per cell first, so the join carries one row per cell.
    """
    cells = (
        points.groupBy(
            F.round(lat, GRID_DIGITS).alias("_lat"), F.round(lon, GRID_DIGITS).alias("_lon")
        )
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    )
    keyed = centroids.select(
        "code_commune",
        F.round("latitude", GRID_DIGITS).alias("_lat"),
        F.round("longitude", GRID_DIGITS).alias("_lon"),
    )
    return cells.join(keyed, ["_lat", "_lon"]).groupBy("code_commune").agg(F.sum("_n").alias(out))


def code_counts(points: DataFrame, code: Column, out: str) -> DataFrame:
    return (
        points.select(code.alias("code_commune"))
        .where(F.col("code_commune").isNotNull())
        .groupBy("code_commune")
        .agg(F.count(F.lit(1)).alias(out))
    )


def _cell(c: Column, level: int) -> Column:
    return F.floor(c / F.lit(CELL * 2.0**level))


def _boxes(df: DataFrame, lat: str, lon: str, level: int, prefix: str) -> DataFrame:
    """Occupied cells of a level with the box their places really fill."""
    return df.groupBy(
        "_g", _cell(F.col(lon), level).alias(f"{prefix}x"), _cell(F.col(lat), level).alias(f"{prefix}y")
    ).agg(
        F.min(lat).alias(f"{prefix}s"), F.max(lat).alias(f"{prefix}n"), F.min(lon).alias(f"{prefix}w"),
        F.max(lon).alias(f"{prefix}e"), F.count(F.lit(1)).alias(f"{prefix}count"),
    )


def _wider(cells: DataFrame, prefix: str) -> DataFrame:
    """Cells of the next level and their boxes from those of a level."""
    p = prefix
    return cells.groupBy(
        "_g", F.shiftright(f"{p}x", 1).alias(f"{p}x"), F.shiftright(f"{p}y", 1).alias(f"{p}y")
    ).agg(
        F.min(f"{p}s").alias(f"{p}s"), F.max(f"{p}n").alias(f"{p}n"), F.min(f"{p}w").alias(f"{p}w"), F.max(f"{p}e").alias(f"{p}e"),
        F.sum(f"{p}count").alias(f"{p}count"),
    )


def _at_least(low: str, high: str, c_low: str, c_high: str) -> Column:
    return F.greatest(F.col(c_low) - F.col(high), F.col(low) - F.col(c_high), F.lit(0.0))


def _bounded(pairs: DataFrame) -> DataFrame:
    """Pairs of a point cell and a centroid cell that may hold a nearest one.

    A centroid cell is no nearer than the gap between both boxes. As each side of its box touches a centroid, some
    centroid is no farther than the nearer side of one axis and the farther corner of the other one, from the worst
    place in the point box. Cells beyond the least such distance of their point cell go; equal ones stay for ties.
    """
    up, across = _at_least("qs", "qn", "cs", "cn"), _at_least("qw", "qe", "cw", "ce")
    farthest = lambda low, high, c: F.greatest(F.abs(F.col(low) - F.col(c)), F.abs(F.col(high) - F.col(c)))
    side_up = F.least(farthest("qs", "qn", "cs"), farthest("qs", "qn", "cn"))
    side_across = F.least(farthest("qw", "qe", "cw"), farthest("qw", "qe", "ce"))
    corner_up = F.greatest(farthest("qs", "qn", "cs"), farthest("qs", "qn", "cn"))
    corner_across = F.greatest(farthest("qw", "qe", "cw"), farthest("qw", "qe", "ce"))
    reach = F.least(side_up * side_up + corner_across * corner_across, corner_up * corner_up + side_across * side_across)
    point_cell = Window.partitionBy("_g", "qx", "qy")
    return (
        pairs.withColumn("_gap", up * up + across * across)
        .withColumn("_reach", F.min(reach).over(point_cell))
        .where(F.col("_gap") <= F.col("_reach"))
        .select("_g", "qx", "qy", "cx", "cy")
    )


def nearest_cells(places: DataFrame, cents: DataFrame) -> tuple[DataFrame, int]:
    """``(_g, qx, qy, cx, cy)``: for each cell of ``places(_g, _lat, _lon)`` the cells of ``cents(_g, _clat, _clon)`` that may
    hold the nearest centroid of one of its places, and the level of the cells.

    Branch and bound on both sides at once: pairs of cells are bounded by the boxes they really fill, halved into the
    occupied pairs of the next level, and bounded again, so a place far from all centroids meets the few in front.
    """
    scale = F.lit(CELL) * F.pow(F.lit(2.0), F.col("_level"))
    levels = cents.select("_g", "_clat", "_clon", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("_level")).select(
        "_g", "_level", F.floor(F.col("_clon") / scale).alias("x"), F.floor(F.col("_clat") / scale).alias("y")
    )
    n = F.col("n")
    # one row for each level
    seen = (
        levels.groupBy("_g", "_level", "x", "y").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("_g", "_level").agg(F.sum(n * n).alias("nn"), F.sum(n).alias("n"), F.count(F.lit(1)).alias("cells"))
        .groupBy("_level").agg((F.sum("nn") / F.sum("n")).alias("crowd"), F.max("cells").alias("cells")).collect()
    )
    bottom = max((r._level for r in seen if r.crowd <= CROWD), default=0)
    top = max(min((r._level for r in seen if r.cells <= ROOTS), default=LEVELS - 1), bottom)
    q = [stored(_boxes(places, "_lat", "_lon", bottom, "q"), "point-cells")]
    c = [stored(_boxes(cents, "_clat", "_clon", bottom, "c"), "centroid-cells")]
    for _ in range(bottom, top):
        q.append(stored(_wider(q[-1], "q"), "point-cells"))
        c.append(stored(_wider(c[-1], "c"), "centroid-cells"))
    found = stored(_bounded(q[-1].join(c[-1], "_g")), "cell-pairs")
    for level in range(top - bottom - 1, -1, -1):
        halves = lambda cells, p: cells.withColumns({f"{p}px": F.shiftright(f"{p}x", 1), f"{p}py": F.shiftright(f"{p}y", 1)})
        wide = found.toDF("_g", "qpx", "qpy", "cpx", "cpy")
        pairs = wide.join(halves(q[level], "q"), ["_g", "qpx", "qpy"]).join(halves(c[level], "c"), ["_g", "cpx", "cpy"])
        # written at each level: planning a chain of all levels takes longer than their small tables
        found = stored(_bounded(pairs), "cell-pairs")
    sized = found.join(q[0].select("_g", "qx", "qy", "qcount"), ["_g", "qx", "qy"])
    return stored(sized.join(c[0].select("_g", "cx", "cy", "ccount"), ["_g", "cx", "cy"]), "cell-pairs"), bottom


def nearest(
    points: DataFrame,
    centroids: DataFrame,
    point_id: Sequence[str],
    within: str | None = None,
    lat: str = "lat",
    lon: str = "lon",
    places: DataFrame | None = None,
) -> DataFrame:
    """Nearest centroid per point (squared degrees, smaller code on a tie): the columns ``point_id`` of each point and its code.

    Exact, and for no point against all centroids: ``nearest_cells`` leaves each occupied point cell few centroid cells. Their
    centroids are listed once for each point cell, and a point takes the nearest of its cell's list in its own row, so points
    are shuffled at most once (not at all where the lists are small enough to broadcast) and never grouped. Points of
    cells with very long lists take the answer of their distinct place instead, and cells with very many points are salted.
    ``places`` are rows with the places of ``points``, if those are cheaper to read than the points themselves.
    """
    group = F.col(within) if within else F.lit(0)
    cents = centroids.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy(
        group.alias("_g"), F.col("latitude").cast("double").alias("_clat"), F.col("longitude").cast("double").alias("_clon")
    ).agg(F.min("code_commune").alias("code_commune"))
    cents = stored(cents, "centroids")

    def located(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & group.isNotNull()).select(
            *columns, group.alias("_g"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")
        )

    cells, level = nearest_cells(located(points if places is None else places), cents.where(F.col("_g").isNotNull()))
    in_cell = cents.withColumns({"cx": _cell(F.col("_clon"), level), "cy": _cell(F.col("_clat"), level)})
    meets = stored(cells.groupBy("_g", "qx", "qy").agg(F.sum("ccount").alias("_met"), F.max("qcount").alias("_points")), "met-cells")
    sizes = meets.agg(F.max("_met").alias("met"), F.max("_points").alias("points")).first()
    long_lists, hot_cells = (sizes.met or 0) > LONG_LIST, (sizes.points or 0) > HOT_CELL

    listed = cells.join(meets.where(F.col("_met") > LONG_LIST), ["_g", "qx", "qy"], "left_anti") if long_lists else cells
    lists = fan_out(listed, "_g", "cx", "cy").join(in_cell, ["_g", "cx", "cy"]).groupBy("_g", "qx", "qy").agg(
        F.sort_array(F.collect_list(F.struct("code_commune", "_clat", "_clon"))).alias("_cents")
    )
    lists = stored(lists, "centroid-lists")
    placed = located(points, *point_id).withColumns({"qx": _cell(F.col("_lon"), level), "qy": _cell(F.col("_lat"), level)})
    keys = ["_g", "qx", "qy"]
    if hot_cells:
        hot = meets.where(F.col("_points") > HOT_CELL).select(*keys, F.lit(True).alias("_hot"))
        salted = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(HOT_SALTS - 1))).otherwise(F.array(F.lit(0)))
        lists = lists.join(hot, keys, "left").withColumn("_salt", F.explode(salted)).drop("_hot")
        salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(*point_id), F.lit(HOT_SALTS))).otherwise(0)
        placed = placed.join(hot, keys, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
        keys = [*keys, "_salt"]

    def distance(clat: Column, clon: Column) -> Column:
        dlat, dlon = F.col("_lat") - clat, F.col("_lon") - clon
        return (dlat * dlat + dlon * dlon).alias("_dist")

    # a list is in the order of codes, so the first of the least distances has the smaller code
    met = placed.join(lists, keys).withColumn("_met", F.transform("_cents", lambda c: distance(c["_clat"], c["_clon"])))
    first = F.array_position("_met", F.array_min("_met")).cast("int")
    best = F.element_at("_cents", first)["code_commune"]
    found = computed_once(met, {"code_commune": best}).select(*point_id, "code_commune")
    if not long_lists:
        return found
    crowded = meets.where(F.col("_met") > LONG_LIST).select("_g", "qx", "qy")
    beside = placed.join(crowded, ["_g", "qx", "qy"], "left_semi")
    rows = fan_out(beside.select("_g", "qx", "qy", "_lat", "_lon").distinct(), "_g", "qx", "qy", "_lat", "_lon")
    pairs = rows.join(cells.drop("qcount", "ccount"), ["_g", "qx", "qy"]).join(in_cell, ["_g", "cx", "cy"])
    answers = pairs.groupBy("_g", "_lat", "_lon").agg(
        F.min(F.struct(distance(F.col("_clat"), F.col("_clon")), "code_commune")).alias("_best")
    )
    return found.unionByName(beside.join(answers, ["_g", "_lat", "_lon"]).select(*point_id, F.col("_best.code_commune").alias("code_commune")))


def bounding_boxes(communes: DataFrame, margin: float = 0.1) -> DataFrame:
    """Per department: box with a margin and mean centre."""
    return communes.dropna(subset=["latitude", "longitude"]).groupBy("code_departement").agg(
        (F.min("latitude") - margin).alias("south"),
        (F.max("latitude") + margin).alias("north"),
        (F.min("longitude") - margin).alias("west"),
        (F.max("longitude") + margin).alias("east"),
        F.avg("latitude").alias("center_lat"),
        F.avg("longitude").alias("center_lon"),
    )


def in_bounding_box(points: DataFrame, boxes: DataFrame, department: str) -> DataFrame:
    """Keeps points inside the box of the department they were fetched for."""
    return (
        points.join(boxes.select("code_departement", "south", "north", "west", "east"),
                    points[department] == boxes["code_departement"])
        .where(F.col("lat").between(F.col("south"), F.col("north"))
               & F.col("lon").between(F.col("west"), F.col("east")))
        .select(points["*"])
    )
