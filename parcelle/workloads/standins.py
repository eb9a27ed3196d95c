"""Domain tables derived from the driver tables, in Spark and as SQL.

The driver tables hold no real estate, so line items play the sales, parts the
communes, nations the departments, regions the regions and events the listings.
Every derivation is a plain expression over whole tables, written twice: once as
a DataFrame and once as the common table expression of the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.functions.cleaning import pad_code, unit_price
from parcelle.sources.files import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_work(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table about to be parsed row by row: evened out if it has too few splits."""
    return spread(table(spark, folder, name))


def code_of(column: str):
    return pad_code(F.col(column).cast("string"))


CODE_SQL = "CASE WHEN length(CAST({0} AS VARCHAR)) < 5 THEN lpad(CAST({0} AS VARCHAR), 5, '0') ELSE CAST({0} AS VARCHAR) END"


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """One sale per line item; the commune name is the code's, so names are unique."""
    return table(spark, folder, "lineitem").select(
        F.col("l_shipdate").alias("date_mutation"),
        F.col("l_extendedprice").alias("valeur_fonciere"),
        F.col("l_quantity").alias("surface_reelle_bati"),
        F.col("l_linenumber").alias("nombre_pieces"),
        F.col("l_returnflag").alias("type_local"),
        code_of("l_partkey").alias("code_commune"),
        F.concat(F.lit("Commune "), F.col("l_partkey").cast("string")).alias("nom_commune"),
        unit_price(F.col("l_extendedprice"), F.col("l_quantity")).alias("prix_m2"),
        F.lit("DVF").alias("source"),
        F.year("l_shipdate").alias("year"),
    )


SALES = f"""sales AS (
    SELECT l_shipdate AS date_mutation, l_extendedprice AS valeur_fonciere, l_quantity AS surface_reelle_bati,
           l_linenumber AS nombre_pieces, l_returnflag AS type_local,
           {CODE_SQL.format('l_partkey')} AS code_commune,
           'Commune ' || CAST(l_partkey AS VARCHAR) AS nom_commune,
           l_extendedprice / nullif(l_quantity, 0) AS prix_m2, 'DVF' AS source,
           CAST(year(l_shipdate) AS INTEGER) AS year
    FROM lineitem)"""


def communes(spark: SparkSession, folder: str) -> DataFrame:
    """One commune per part; every ninth has no coordinates, every eleventh no population."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        code_of("p_partkey").alias("code_commune"),
        F.concat(F.lit("Commune "), key.cast("string")).alias("nom_commune"),
        F.lpad((key % 25).cast("string"), 2, "0").alias("code_departement"),
        (key % 5).cast("string").alias("code_region"),
        F.when(key % 9 != 0, (41_000 + (key * 7_919) % 10_000) / 1_000.0).alias("latitude"),
        F.when(key % 9 != 0, ((key * 6_007) % 14_000 - 5_000) / 1_000.0).alias("longitude"),
        F.when(key % 11 != 0, ((key * key * 31 + key * 17) % 60_000).cast("int")).alias("population"),
        F.concat(
            F.lit("P"), (key % 700).cast("string"), F.lit(","), F.lit("P"), ((key * 3) % 900).cast("string")
        ).alias("codes_postaux"),
    )


COMMUNES = f"""communes AS (
    SELECT {CODE_SQL.format('p_partkey')} AS code_commune,
           'Commune ' || CAST(p_partkey AS VARCHAR) AS nom_commune,
           lpad(CAST(p_partkey % 25 AS VARCHAR), 2, '0') AS code_departement,
           CAST(p_partkey % 5 AS VARCHAR) AS code_region,
           CASE WHEN p_partkey % 9 <> 0 THEN CAST(41000 + (p_partkey * 7919) % 10000 AS DOUBLE) / 1000.0 END AS latitude,
           CASE WHEN p_partkey % 9 <> 0 THEN CAST((p_partkey * 6007) % 14000 - 5000 AS DOUBLE) / 1000.0 END AS longitude,
           CASE WHEN p_partkey % 11 <> 0
                THEN CAST((p_partkey * p_partkey * 31 + p_partkey * 17) % 60000 AS INTEGER) END AS population,
           'P' || CAST(p_partkey % 700 AS VARCHAR) || ',P' || CAST((p_partkey * 3) % 900 AS VARCHAR) AS codes_postaux
    FROM part)"""


def departments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code_departement"),
        F.col("n_name").alias("nom_departement"),
        F.col("n_regionkey").cast("string").alias("code_region"),
    )


DEPARTMENTS = """departements AS (
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code_departement, n_name AS nom_departement,
           CAST(n_regionkey AS VARCHAR) AS code_region
    FROM nation)"""


def regions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "region").select(
        F.col("r_regionkey").cast("string").alias("code_region"), F.col("r_name").alias("nom_region")
    )


REGIONS = "regions AS (SELECT CAST(r_regionkey AS VARCHAR) AS code_region, r_name AS nom_region FROM region)"

# Price mart of all years with the change against the year before.
GOLD = """stats AS (
    SELECT code_commune, nom_commune, year, count(*) AS transaction_count, avg(valeur_fonciere) AS avg_price,
           avg(prix_m2) AS avg_price_m2, median(prix_m2) AS median_price_m2, avg(surface_reelle_bati) AS avg_surface
    FROM sales WHERE prix_m2 BETWEEN 200 AND 30000
    GROUP BY code_commune, nom_commune, year HAVING count(*) >= 3),
gold AS (
    SELECT s.*, (s.avg_price_m2 - p.avg_price_m2) / p.avg_price_m2 AS price_m2_yoy_variation
    FROM stats s LEFT JOIN stats p ON p.code_commune = s.code_commune AND p.year = s.year - 1)"""


def gold(spark: SparkSession, folder: str) -> DataFrame:
    from parcelle.plans.gold import commune_prices, with_yoy

    return with_yoy(commune_prices(sales(spark, folder)))


# Commune-level prices over all years: the input of the territory tables.
PRICES = """prices AS (
    SELECT code_commune, sum(transaction_count) AS transaction_count, avg(avg_price) AS avg_price,
           avg(avg_price_m2) AS avg_price_m2, avg(median_price_m2) AS median_price_m2,
           max(price_m2_yoy_variation) AS price_m2_yoy_variation
    FROM gold GROUP BY code_commune)"""


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return gold(spark, folder).groupBy("code_commune").agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.avg("avg_price").alias("avg_price"),
        F.avg("avg_price_m2").alias("avg_price_m2"),
        F.avg("median_price_m2").alias("median_price_m2"),
        F.max("price_m2_yoy_variation").alias("price_m2_yoy_variation"),
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as listing snapshots: every thirteenth has no id, every seventh a postal code."""
    ident = F.col("event_id")
    return table(spark, folder, "events").select(
        F.when(ident % 13 == 0, F.lit("")).otherwise(F.get_json_object("props", "$.k")).alias("listing_id"),
        F.col("event_type").alias("source"),
        F.when(ident % 7 == 0, F.concat(F.lit("P"), (F.col("user_id") % 950).cast("string")))
        .otherwise(code_of("user_id")).alias("commune_code"),
        F.col("value").alias("price_m2"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
        F.col("event_id"),
    )


LISTINGS = f"""listings AS (
    SELECT CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(json_extract_string(props, '$.k') AS VARCHAR) END AS listing_id,
           event_type AS source,
           CASE WHEN event_id % 7 = 0 THEN 'P' || CAST(user_id % 950 AS VARCHAR)
                ELSE {CODE_SQL.format('user_id')} END AS commune_code,
           value AS price_m2, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS scraped_at, event_id
    FROM events)"""

LATEST = """latest AS (
    SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY source, listing_id
                                     ORDER BY scraped_at DESC, event_id DESC) AS place
        FROM valid WHERE listing_id <> '') WHERE place = 1
    UNION ALL SELECT * FROM valid WHERE listing_id = '')"""
VALID = "valid AS (SELECT * FROM listings WHERE trim(commune_code) <> '' AND price_m2 > 0)"
LISTING_STATS = """listing_stats AS (
    SELECT source AS source_name, commune_code AS code_commune, count(*) AS listing_count,
           avg(price_m2) AS avg_listing_price_m2, median(price_m2) AS median_listing_price_m2,
           min(price_m2) AS min_listing_price_m2, max(price_m2) AS max_listing_price_m2,
           max(scraped_at) AS last_updated
    FROM latest GROUP BY source, commune_code)"""


def listing_stats(spark: SparkSession, folder: str) -> DataFrame:
    from parcelle.streaming.listings_stream import silver_listings

    return silver_listings(listings(spark, folder), ties=["event_id"])


def equipment(spark: SparkSession, folder: str) -> DataFrame:
    """One equipment row per line item; the type code walks through real and unknown codes."""
    step = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 48
    return table(spark, folder, "lineitem").select(
        code_of("l_partkey").alias("CODGEO"),
        F.concat(
            F.substring(F.lit("ABCDFX"), (step % 6 + 1).cast("int"), F.lit(1)),
            (F.floor(step / 12) + 1).cast("string"), F.lit("0"), (step % 8 + 1).cast("string"),
        ).alias("TYPEQU"),
    )


def _equipment_values() -> str:
    from parcelle.params import EQUIPMENT_CODES

    return ", ".join(f"('{code}', '{category}')" for category, codes in EQUIPMENT_CODES.items() for code in codes)


EQUIPMENT = f"""equipment AS (
    SELECT CODGEO, substr('ABCDFX', CAST(step % 6 + 1 AS INTEGER), 1) || CAST(step // 12 + 1 AS VARCHAR) || '0'
                   || CAST(step % 8 + 1 AS VARCHAR) AS TYPEQU
    FROM (SELECT {CODE_SQL.format('l_partkey')} AS CODGEO,
                 (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 48 AS step FROM lineitem)),
categories(code, category) AS (VALUES {_equipment_values()}),
equipment_counts AS (
    SELECT CODGEO AS code_commune,
           count(*) FILTER (category = 'school_count') AS school_count,
           count(*) FILTER (category = 'university_count') AS university_count,
           count(*) FILTER (category = 'hospital_count') AS hospital_count,
           count(*) FILTER (category = 'pharmacy_count') AS pharmacy_count,
           count(*) FILTER (category = 'supermarket_count') AS supermarket_count,
           count(*) FILTER (category = 'restaurant_count') AS restaurant_count,
           count(*) FILTER (category = 'park_count') AS park_count,
           count(*) FILTER (category = 'transport_count') AS transport_count
    FROM equipment JOIN categories ON code = TYPEQU GROUP BY CODGEO)"""


def network_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as mobile sites with comma decimals and gaps."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") % 1500).cast("string").alias("insee_com"),
        F.when(key % 10 != 0, F.replace((key % 101 / 4).cast("string"), F.lit("."), F.lit(","))).alias("site_4g"),
        F.when(key % 3 != 0, F.replace((key % 53 / 2).cast("string"), F.lit("."), F.lit(","))).alias("site_5g"),
        F.lit("2024-01-01").alias("date_5g"),
    )


NETWORK = """network AS (
    SELECT code_commune, CASE WHEN g4 IS NULL THEN g5 WHEN g5 IS NULL THEN g4 ELSE (g4 + g5) / 2 END AS network_score_raw
    FROM (SELECT lpad(CAST(o_custkey % 1500 AS VARCHAR), 5, '0') AS code_commune,
                 avg(CASE WHEN o_orderkey % 10 <> 0 THEN (o_orderkey % 101) / 4.0 END) AS g4,
                 avg(CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 53) / 2.0 END) AS g5
          FROM orders GROUP BY 1))"""


def incomes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        code_of("c_custkey").alias("code_commune"),
        F.when(F.col("c_custkey") % 8 != 0, F.col("c_acctbal")).alias("median_income_raw"),
    )


INCOMES = f"""incomes AS (
    SELECT {CODE_SQL.format('c_custkey')} AS code_commune,
           CASE WHEN c_custkey % 8 <> 0 THEN c_acctbal END AS median_income_raw
    FROM customer)"""


def rents(spark: SparkSession, folder: str) -> DataFrame:
    """Rents of all communes; a third of them have no observation, all nulls."""
    key = F.col("p_partkey")
    columns = {
        "loyer_m2_app": F.col("p_size") / 4.0 + 6,
        "loyer_m2_app_min": F.col("p_size") / 4.0 + 4,
        "loyer_m2_app_max": F.col("p_size") / 4.0 + 8,
        "loyer_m2_app12": F.col("p_size") / 4.0 + 7,
        "loyer_m2_app3": F.col("p_size") / 4.0 + 5,
        "nb_annonces_app": (key % 40).cast("int"),
        "marche_locatif_actif": key % 40 > 0,
    }
    return table(spark, folder, "part").select(
        code_of("p_partkey").alias("code_commune"), *[F.when(key % 3 != 0, c).alias(n) for n, c in columns.items()]
    )


_OBSERVED = {
    "loyer_m2_app": "p_size / 4.0 + 6", "loyer_m2_app_min": "p_size / 4.0 + 4", "loyer_m2_app_max": "p_size / 4.0 + 8",
    "loyer_m2_app12": "p_size / 4.0 + 7", "loyer_m2_app3": "p_size / 4.0 + 5",
    "nb_annonces_app": "CAST(p_partkey % 40 AS INTEGER)", "marche_locatif_actif": "p_partkey % 40 > 0",
}
RENTS = f"""rents AS (
    SELECT {CODE_SQL.format('p_partkey')} AS code_commune,
           {', '.join(f'CASE WHEN p_partkey % 3 <> 0 THEN {c} END AS {n}' for n, c in _OBSERVED.items())}
    FROM part)"""


def property_tax(spark: SparkSession, folder: str) -> DataFrame:
    """Department rate by the fixed table, rental value for half of the communes."""
    from parcelle.operators.joins import property_tax_rate

    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        code_of("p_partkey").alias("code_commune"),
        property_tax_rate(F.lpad((key % 100).cast("string"), 2, "0")).alias("taux_tfb_dept"),
        F.when(key % 2 == 0, F.col("p_size") / 8.0 + 2).alias("vl_m2_commune"),
    )


def _tax_values() -> str:
    from parcelle.params import PROPERTY_TAX_RATES

    return ", ".join(f"('{d}', CAST({r} AS DOUBLE))" for d, r in PROPERTY_TAX_RATES.items())


PROPERTY_TAX = f"""tax_rates(dept, rate) AS (VALUES {_tax_values()}),
property_tax AS (
    SELECT {CODE_SQL.format('p_partkey')} AS code_commune, coalesce(rate, 22.5) AS taux_tfb_dept,
           CASE WHEN p_partkey % 2 = 0 THEN p_size / 8.0 + 2 END AS vl_m2_commune
    FROM part LEFT JOIN tax_rates ON dept = lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0'))"""


def territory(
    spark: SparkSession, folder: str, keep: bool = False, scores: list[str] | None = None, columns: list[str] | None = None
) -> DataFrame:
    """The territory table; ``keep`` writes it out where several steps read it, ``scores`` or ``columns`` asks for these alone."""
    from parcelle.operators.aggregates import equipment_counts, network_coverage
    from parcelle.plans.territory import territory_scores
    from parcelle.session import stored

    built = territory_scores(
        communes(spark, folder).drop("codes_postaux"),
        prices(spark, folder),
        regions=regions(spark, folder),
        equipment=equipment_counts(equipment(spark, folder)),
        network=network_coverage(network_sites(spark, folder)),
        rents=rents(spark, folder),
        property_tax=property_tax(spark, folder),
        incomes=incomes(spark, folder),
        columns=columns if scores is None else scores,
    )
    return stored(built, "scores") if keep else built


def rank_sql(x: str) -> str:
    """Percentile rank of ties' mean, null scores 50 (before rounding)."""
    return (
        f"coalesce((rank() OVER (ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY {x}) - 1) / 2.0)"
        f" * CASE WHEN {x} IS NOT NULL THEN 1.0 END / count({x}) OVER () * 100, 50.0)"
    )


def round_sql(x: str, digits: int) -> str:
    """Half-up on decimals, as the library's rounding."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 9)), {digits}) AS DOUBLE)"


def score_sql(x: str, inverse: bool = False) -> str:
    raw = rank_sql(x)
    return round_sql(f"100 - {raw}" if inverse else raw, 2)


def persona_sql(weights) -> str:
    total = sum(weights.values())
    parts = " + ".join(f"coalesce({c}, 50) * CAST({w} AS DOUBLE)" for c, w in weights.items())
    return round_sql(f"({parts}) / CAST({total!r} AS DOUBLE)", 2)


def _territory_sql() -> str:
    from parcelle.params import PERSONA_WEIGHTS

    people = "greatest(coalesce(population, 1), 1)"

    def density(a, b):
        return f"(coalesce({a}, 0) + coalesce({b}, 0)) / CAST({people} AS DOUBLE) * 10000"

    stops = f"coalesce(bus_stop_count, 0) / CAST({people} AS DOUBLE) * 10000"
    personas = ", ".join(f"{persona_sql(w)} AS {n}" for n, w in PERSONA_WEIGHTS.items())
    return f"""base AS (
    SELECT c.code_commune, c.nom_commune, c.code_departement, c.code_region, r.nom_region AS region, c.latitude,
           c.longitude, c.population, p.avg_price_m2, p.avg_price, p.median_price_m2,
           CAST(p.transaction_count AS BIGINT) AS transaction_count, p.price_m2_yoy_variation AS annual_price_growth,
           e.* EXCLUDE (code_commune), e.transport_count AS bus_stop_count, n.network_score_raw, i.median_income_raw,
           l.* EXCLUDE (code_commune, marche_locatif_actif),
           coalesce(l.marche_locatif_actif, false) AS marche_locatif_actif, t.taux_tfb_dept, t.vl_m2_commune
    FROM communes c JOIN prices p USING (code_commune) LEFT JOIN regions r ON r.code_region = c.code_region
    LEFT JOIN equipment_counts e ON e.code_commune = c.code_commune
    LEFT JOIN network n ON n.code_commune = c.code_commune LEFT JOIN incomes i ON i.code_commune = c.code_commune
    LEFT JOIN rents l ON l.code_commune = c.code_commune
    LEFT JOIN property_tax t ON t.code_commune = c.code_commune),
filled AS (
    SELECT * REPLACE (coalesce(network_score_raw, (SELECT median(network_score_raw) FROM base)) AS network_score_raw,
                      coalesce(median_income_raw, (SELECT median(median_income_raw) FROM base)) AS median_income_raw),
           {density('park_count', '0')} AS green, {density('school_count', 'university_count')} AS education,
           {density('hospital_count', 'pharmacy_count')} AS health,
           {density('supermarket_count', 'restaurant_count')} AS services,
           CASE WHEN (SELECT 100.0 * count(*) FILTER ({stops} > 0) / count(*) FROM base) >= 20
                THEN {stops} ELSE ln(1 + coalesce(population, 0)) END AS transport,
           coalesce(annual_price_growth, 0) AS growth
    FROM base),
scored AS (
    SELECT *, {score_sql('avg_price_m2', True)} AS affordability_score, {score_sql('transport')} AS transport_score,
           {score_sql('network_score_raw')} AS network_score, {score_sql('green')} AS green_score,
           {score_sql('services')} AS services_score, {score_sql('education')} AS education_score,
           {score_sql('health')} AS health_score, {score_sql('growth')} AS investment_potential_score,
           {score_sql('median_income_raw')} AS income_score
    FROM filled),
territory AS (
    SELECT * EXCLUDE (network_score_raw, median_income_raw, green, education, health, services, transport, growth),
           {personas}
    FROM scored WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND avg_price_m2 IS NOT NULL)"""


TERRITORY = _territory_sql()
TERRITORY_INPUTS = ", ".join(
    [SALES, GOLD, PRICES, COMMUNES, REGIONS, EQUIPMENT, NETWORK, INCOMES, RENTS, PROPERTY_TAX]
)
TERRITORY_ALL = f"{TERRITORY_INPUTS}, {TERRITORY}"
