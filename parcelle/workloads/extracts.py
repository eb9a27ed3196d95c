"""Open-data extracts written as semicolon files of texts, read back and brought to their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parcelle.plans import extracts
from parcelle.session import work_folder
from parcelle.sources.files import read_csv_strings
from parcelle.workloads import standins as S
from parcelle.workloads.registry import query, rounded
from parcelle.workloads.spatial import POINTS, _points


def _texts(df, case="lower"):
    """``df`` as texts with decimal commas, through a file."""
    place = f"{work_folder(df.sparkSession)}/extract-{uuid.uuid4().hex}"
    cells = [F.translate(F.col(f"`{n}`").cast("string"), ".", ",") if t == "double" else F.col(f"`{n}`").cast("string") for n, t in df.dtypes]
    df.select(*[c.alias(n) for c, n in zip(cells, df.columns, strict=True)]).write.options(header=True, sep=";", escape='"').csv(place)
    return read_csv_strings(df.sparkSession, place, case=case)


@query(
    "extract_incomes",
    f"""SELECT {S.CODE_SQL.format('c_custkey')} AS code_commune, rnd(c_acctbal, 2) AS median_income_raw
        FROM customer WHERE c_custkey % 8 <> 0""",
)
def extract_incomes(spark, folder):
    key = F.col("c_custkey")
    raw = S.table(spark, folder, "customer").select(
        F.col("c_name").alias("LIBGEO"), key.alias(" CODGEO"), F.when(key % 8 != 0, F.translate(F.col("c_acctbal").cast("string"), ".", ",")).otherwise("s").alias("Q213 "),
        F.col("c_nationkey").alias("MED_OTHER"),
    )
    return rounded(extracts.incomes(_texts(raw)), 2)


@query(
    "extract_rents",
    f"""WITH p AS (SELECT {S.CODE_SQL.format('p_partkey')} AS code_commune, p_size / 4.0 AS r, p_partkey % 4 AS n, p_type AS q FROM part),
        c AS (SELECT {S.CODE_SQL.format('c_custkey')} AS code_commune, c_acctbal AS r, c_nationkey AS n FROM customer),
        s AS (SELECT {S.CODE_SQL.format('s_suppkey')} AS code_commune, s_acctbal AS r, s_nationkey AS n FROM supplier)
        SELECT code_commune, rnd(p.r, 2) AS loyer_m2_app, rnd(p.r - 1, 2) AS loyer_m2_app_min, rnd(p.r + 1, 2) AS loyer_m2_app_max,
        p.n::DOUBLE AS nb_annonces_app, p.q AS qualite_app, rnd(c.r, 2) AS loyer_m2_app12, c.n::DOUBLE AS nb_annonces_app12,
        rnd(s.r, 2) AS loyer_m2_app3, s.n::DOUBLE AS nb_annonces_app3, p.n > 0 AS marche_locatif_actif
        FROM p LEFT JOIN c USING (code_commune) LEFT JOIN s USING (code_commune)""",
)
def extract_rents(spark, folder):
    def source(name, key, rent, count, quality):
        return _texts(S.table(spark, folder, name).select(
            F.col(key).alias("INSEE_C"), rent.alias("loypredm2"), (rent - 1).alias("lwr.IPm2"), (rent + 1).alias("upr.IPm2"),
            count.alias("nbobs_com"), quality.alias("TYPPRED"),
        ), case="keep")

    merged = extracts.rents(
        source("part", "p_partkey", F.col("p_size") / 4.0, F.col("p_partkey") % 4, F.col("p_type")),
        source("customer", "c_custkey", F.col("c_acctbal"), F.col("c_nationkey"), F.lit("maille")),
        source("supplier", "s_suppkey", F.col("s_acctbal"), F.col("s_nationkey"), F.lit("commune")),
    )
    return rounded(merged.select(
        "code_commune", "loyer_m2_app", "loyer_m2_app_min", "loyer_m2_app_max", "nb_annonces_app", "qualite_app", "loyer_m2_app12",
        "nb_annonces_app12", "loyer_m2_app3", "nb_annonces_app3", "marche_locatif_actif",
    ), 2)


@query(
    "extract_property_tax",
    f"""WITH {S.COMMUNES}, tax_rates(dept, rate) AS (VALUES {S._tax_values()}),
        v AS (SELECT {S.CODE_SQL.format('l_partkey')} AS code_commune, CASE WHEN l_orderkey % 6 <> 0 THEN l_extendedprice / 1000 END AS vl
            FROM lineitem WHERE l_returnflag = 'R'),
        m AS (SELECT code_commune, median(vl) AS vl_m2_commune FROM v WHERE vl IS NOT NULL GROUP BY 1)
        SELECT c.code_commune, rnd(vl_m2_commune, 4) AS vl_m2_commune, coalesce(rate, 22.5) AS taux_tfb_dept FROM communes c
        LEFT JOIN m USING (code_commune) LEFT JOIN tax_rates ON dept = c.code_departement""",
)
def extract_property_tax(spark, folder):
    values = _texts(S.table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", " D ").otherwise("M").alias("NATURE_LOCAUX"),
        F.when(F.col("l_orderkey") % 6 != 0, (F.col("l_extendedprice") / 1000).cast("string")).otherwise("n.c.").alias("VL_AU_M2"),
        F.col("l_partkey").alias("Code_Commune"),
    ))
    return rounded(extracts.property_tax(values, S.communes(spark, folder)))


_FLAGS = "false AS has_train, false AS has_metro, false AS has_tram"


@query(
    "extract_stops",
    f"""SELECT {S.CODE_SQL.format('l_partkey')} AS code_commune, count(*) AS stop_count, {_FLAGS}, true AS has_bus FROM lineitem GROUP BY 1""",
)
def extract_stops(spark, folder):
    """Stops with a municipality column, routes known."""
    raw = _texts(S.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("stop_id"), F.col("l_partkey").alias("Code_INSEE"), F.col("l_tax").alias("stop_lat"), F.col("l_discount").alias("stop_lon")
    ))
    routes = spark.createDataFrame([("3",)], "route_type string")
    return extracts.stops(raw, S.communes(spark, folder), routes)


@query(
    "extract_stops_by_place",
    f"""WITH {POINTS}, {S.COMMUNES} SELECT code_commune, count(*) AS stop_count, {_FLAGS}, false AS has_bus FROM points JOIN communes
        ON {S.round_sql('lat', 2)} = {S.round_sql('latitude', 2)} AND {S.round_sql('lon', 2)} = {S.round_sql('longitude', 2)} GROUP BY 1""",
)
def extract_stops_by_place(spark, folder):
    """Stops without a municipality column, by rounded coordinates."""
    raw = _points(spark, folder).select(F.col("l_orderkey").alias("stop_id"), F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"))
    return extracts.stops(_texts(raw), S.communes(spark, folder))
