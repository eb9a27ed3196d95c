"""Places: counts by category, grid and nearest joins, boxes, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle.operators import aggregates, joins, spatial
from parcelle.params import POI_TYPES
from parcelle.workloads import standins as S
from parcelle.workloads.registry import query, rounded


def _points(spark, folder):
    """Line items as points of interest around the communes' area."""
    return _placed(S.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"))


def _placed(rows):
    """Place, department and type, which follow from the keys of a row."""
    step = (F.col("l_orderkey") * 7_919 + F.col("l_linenumber") * 104_729 + F.col("l_partkey") * 31) % 1_000_003
    kind = F.element_at(F.array(*[F.lit(t) for t in POI_TYPES]), (step % 10 + 1).cast("int"))
    return rows.select(
        "*",
        F.lpad((F.col("l_partkey") % 25).cast("string"), 2, "0").alias("code_departement"),
        ((step % 10_007 + 41_000) / 1_000.0).alias("lat"),
        ((step * 13 % 14_009 - 5_000) / 1_000.0).alias("lon"),
        kind.alias("poi_type"),
    )


POINTS = f"""points AS (
    SELECT l_orderkey, l_linenumber, l_partkey, lpad(CAST(l_partkey % 25 AS VARCHAR), 2, '0') AS code_departement,
           CAST(step % 10007 + 41000 AS DOUBLE) / 1000.0 AS lat, CAST(step * 13 % 14009 - 5000 AS DOUBLE) / 1000.0 AS lon,
           ['{"', '".join(POI_TYPES)}'][CAST(step % 10 + 1 AS INTEGER)] AS poi_type
    FROM (SELECT *, (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000003 AS step FROM lineitem))"""
_ID = ["l_orderkey", "l_linenumber", "l_partkey", "copy"]


def _numbered(spark, folder):
    """All points with a key: rows equal in order, line and part lie at one place and are numbered as copies.

    Only the keys are shuffled; what follows from them is worked out afterwards.
    """
    counted = S.table(spark, folder, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_partkey").agg(F.count("*").alias("n"))
    copies = F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")
    return _placed(counted.select("l_orderkey", "l_linenumber", "l_partkey", copies))


NUMBERED = f"""{POINTS}, numbered AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey) AS INTEGER) AS copy FROM points)"""


def _nearest_sql(extra: str) -> str:
    return f"""nearest AS (
        SELECT l_orderkey, l_linenumber, l_partkey, copy, arg_min(c.code_commune, ((p.lat - latitude) * (p.lat - latitude)
               + (p.lon - longitude) * (p.lon - longitude), c.code_commune)) AS code_commune
        FROM numbered p JOIN communes c ON c.latitude IS NOT NULL {extra} GROUP BY 1, 2, 3, 4)"""


@query(
    "nearest_join",
    f"WITH {NUMBERED}, {S.COMMUNES}, {_nearest_sql('AND c.code_departement = p.code_departement')} SELECT * FROM nearest",
)
def nearest_join(spark, folder):
    """Nearest commune of the point's own department."""
    points, communes = _numbered(spark, folder), S.communes(spark, folder)
    return spatial.nearest(points, communes, _ID, within="code_departement", places=_points(spark, folder))


@query("nearest_join_anywhere", f"WITH {NUMBERED}, {S.COMMUNES}, {_nearest_sql('')} SELECT * FROM nearest")
def nearest_join_anywhere(spark, folder):
    """Nearest commune of all."""
    return spatial.nearest(_numbered(spark, folder), S.communes(spark, folder), _ID, places=_points(spark, folder))


_POI = ", ".join(f"CAST(count(poi_type) FILTER (poi_type = '{t}') AS INTEGER) AS {t}_count" for t in POI_TYPES)


@query(
    "poi_counts",
    f"""WITH {NUMBERED}, {S.COMMUNES}, {_nearest_sql('AND c.code_departement = p.code_departement')}
        SELECT c.code_commune, {_POI} FROM communes c LEFT JOIN (SELECT n.code_commune, p.poi_type FROM nearest n
        JOIN numbered p USING (l_orderkey, l_linenumber, l_partkey, copy)) q ON q.code_commune = c.code_commune GROUP BY 1""",
)
def poi_counts(spark, folder):
    """Assigned points counted by type; every commune appears."""
    communes = S.communes(spark, folder)
    # the type goes along with its point, so no point needs a number to find it again
    assigned = spatial.nearest(_points(spark, folder), communes, [*_ID[:3], "poi_type"], within="code_departement")
    return joins.complete_counts(communes, aggregates.poi_counts(assigned), [f"{t}_count" for t in POI_TYPES])


@query(
    "grid_join",
    f"""WITH {POINTS}, {S.COMMUNES} SELECT code_commune, count(*) AS stop_count FROM points JOIN communes
        ON {S.round_sql('lat', 2)} = {S.round_sql('latitude', 2)} AND {S.round_sql('lon', 2)} = {S.round_sql('longitude', 2)} GROUP BY 1""",
)
def grid_join(spark, folder):
    return spatial.grid_counts(_points(spark, folder), S.communes(spark, folder), "lat", "lon", "stop_count")


@query(
    "stop_flags",
    f"""WITH {S.SALES} SELECT code_commune, count(*) AS stop_count, false AS has_train, false AS has_metro, false AS has_tram,
        true AS has_bus FROM sales GROUP BY 1""",
)
def stop_flags(spark, folder):
    stops = spatial.code_counts(S.sales(spark, folder), F.col("code_commune"), "stop_count")
    return aggregates.stop_flags(stops, routes_known=True)


_BOX = """boxes AS (SELECT code_departement, min(latitude) - 0.1 AS south, max(latitude) + 0.1 AS north, min(longitude) - 0.1 AS west,
    max(longitude) + 0.1 AS east, avg(latitude) AS center_lat, avg(longitude) AS center_lon
    FROM communes WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1)"""


@query(
    "department_boxes",
    f"""WITH {S.COMMUNES}, {_BOX} SELECT code_departement, rnd(south, 4) AS south, rnd(north, 4) AS north, rnd(west, 4) AS west,
        rnd(east, 4) AS east, rnd(center_lat, 4) AS center_lat, rnd(center_lon, 4) AS center_lon FROM boxes""",
)
def department_boxes(spark, folder):
    return rounded(spatial.bounding_boxes(S.communes(spark, folder)))


@query(
    "points_in_boxes",
    f"""WITH {POINTS}, {S.COMMUNES}, {_BOX} SELECT code_departement, count(*) AS n FROM points JOIN boxes USING (code_departement)
        WHERE lat BETWEEN south AND north AND lon BETWEEN west AND east GROUP BY 1""",
)
def points_in_boxes(spark, folder):
    boxes = spatial.bounding_boxes(S.communes(spark, folder))
    inside = spatial.in_bounding_box(_points(spark, folder), boxes, "code_departement")
    return inside.groupBy("code_departement").agg(F.count(F.lit(1)).alias("n"))


@query("equipment_counts", f"WITH {S.EQUIPMENT} SELECT * FROM equipment_counts")
def equipment_counts(spark, folder):
    return aggregates.equipment_counts(S.equipment(spark, folder))


@query("network_coverage", f"WITH {S.NETWORK} SELECT code_commune, rnd(network_score_raw, 6) AS network_score_raw FROM network")
def network_coverage(spark, folder):
    return rounded(aggregates.network_coverage(S.network_sites(spark, folder)), 6)


@query(
    "rental_values",
    f"""WITH v AS (SELECT {S.CODE_SQL.format('l_partkey')} AS code_commune,
            CASE WHEN l_orderkey % 6 <> 0 THEN l_extendedprice / 1000 END AS vl FROM lineitem WHERE l_returnflag = 'R')
        SELECT code_commune, rnd(median(vl), 4) AS vl_m2_commune FROM v WHERE vl IS NOT NULL GROUP BY 1""",
)
def rental_values(spark, folder):
    rows = S.table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", " D ").otherwise("M").alias("nature_locaux"),
        F.when(F.col("l_orderkey") % 6 != 0, (F.col("l_extendedprice") / 1000).cast("string")).otherwise("n.c.").alias("vl_au_m2"),
        F.col("l_partkey").alias("code_commune"),
    )
    return rounded(aggregates.rental_values(rows))


@query("property_tax_rates", f"WITH {S.PROPERTY_TAX} SELECT * FROM property_tax")
def property_tax_rates(spark, folder):
    return S.property_tax(spark, folder)
