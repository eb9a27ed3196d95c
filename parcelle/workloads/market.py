"""Sales cleaning, price marts and their SQL reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parcelle.functions import cleaning as c
from parcelle.operators import aggregates, columns, filters, joins
from parcelle.plans import gold as G
from parcelle.plans import serving, silver, star
from parcelle.session import stored, work_folder
from parcelle.sources import files
from parcelle.workloads import standins as S
from parcelle.workloads.registry import query, rounded

GOLD_ROUNDED = """SELECT code_commune, nom_commune, year, transaction_count, rnd(avg_price, 4) AS avg_price,
    rnd(avg_price_m2, 4) AS avg_price_m2, rnd(median_price_m2, 4) AS median_price_m2,
    rnd(avg_surface, 4) AS avg_surface, rnd(price_m2_yoy_variation, 6) AS price_m2_yoy_variation FROM gold"""


@query("gold_real_estate_yoy", f"WITH {S.SALES}, {S.GOLD} {GOLD_ROUNDED}")
def gold_real_estate_yoy(spark, folder):
    return rounded(S.gold(spark, folder), price_m2_yoy_variation=6)


@query(
    "gold_real_estate_one_year",
    f"""WITH {S.SALES}, {S.GOLD} {GOLD_ROUNDED} WHERE year = 1998""",
)
def gold_real_estate_one_year(spark, folder):
    """The yearly job: this year's mart joined to the stored mart of the year before."""
    sales = S.sales(spark, folder)
    current = G.commune_prices(sales.where(F.col("year") == 1998))
    previous = G.commune_prices(sales.where(F.col("year") == 1997))
    return rounded(G.with_previous(current, previous), price_m2_yoy_variation=6)


RAW_SALES = """raw AS (
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS date_mutation,
           CASE WHEN l_orderkey % 50 = 0 THEN 'nan' WHEN l_orderkey % 50 = 1 THEN 'abc' WHEN l_orderkey % 50 = 2 THEN ''
                ELSE replace(CAST(l_extendedprice AS VARCHAR), '.', ',') END AS valeur_fonciere,
           CASE WHEN l_orderkey % 40 = 0 THEN '0' WHEN l_orderkey % 40 = 1 THEN NULL
                ELSE ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS surface_reelle_bati,
           CAST(l_linenumber AS VARCHAR) AS nombre_pieces, l_returnflag AS type_local,
           CASE WHEN l_orderkey % 30 = 0 THEN 'nan' ELSE CAST(l_partkey AS VARCHAR) || '.0' END AS code_commune,
           p_name AS commune, CAST(l_suppkey AS VARCHAR) || '.0' AS code_postal, CAST(year(l_shipdate) AS INTEGER) AS year
    FROM lineitem JOIN part ON p_partkey = l_partkey)"""
TITLE = ("list_aggregate(list_transform(regexp_extract_all(lower(trim({0})), '[a-z]+|[^a-z]+'), "
         "lambda x: upper(x[1]) || x[2:]), 'string_agg', '')")
TYPED_SALES = f"""typed AS (
    SELECT CAST(date_mutation AS TIMESTAMP) AS date_mutation,
           TRY_CAST(replace(replace(valeur_fonciere, ',', '.'), ' ', '') AS DOUBLE) AS valeur_fonciere,
           TRY_CAST(replace(surface_reelle_bati, ' ', '') AS DOUBLE) AS surface_reelle_bati,
           CAST(nombre_pieces AS INTEGER) AS nombre_pieces, type_local,
           CASE WHEN code_commune <> 'nan' THEN
                CASE WHEN length(replace(code_commune, '.0', '')) < 5 THEN lpad(replace(code_commune, '.0', ''), 5, '0')
                     ELSE replace(code_commune, '.0', '') END END AS code_commune,
           {TITLE.format('commune')} AS nom_commune, replace(code_postal, '.0', '') AS code_postal, year
    FROM raw),
clean AS (
    SELECT DISTINCT *, valeur_fonciere / nullif(surface_reelle_bati, 0) AS prix_m2, 'DVF' AS source FROM typed
    WHERE valeur_fonciere > 0 AND surface_reelle_bati > 0 AND code_commune IS NOT NULL
      AND isfinite(valeur_fonciere) AND valeur_fonciere / nullif(surface_reelle_bati, 0) BETWEEN 100 AND 50000)"""


def _raw_sales(spark, folder):
    key = F.col("l_orderkey")
    items = S.wide_work(spark, folder, "lineitem")
    names = S.table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("commune"))
    return items.join(names, items.l_partkey == names.p_partkey).select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_mutation"),
        F.when(key % 50 == 0, "nan").when(key % 50 == 1, "abc").when(key % 50 == 2, "")
        .otherwise(F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))).alias("valeur_fonciere"),
        F.when(key % 40 == 0, "0").when(key % 40 == 1, F.lit(None))
        .otherwise(F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string"))).alias("surface_reelle_bati"),
        F.col("l_linenumber").cast("string").alias("nombre_pieces_principales"),
        F.col("l_returnflag").alias("type_local"),
        F.when(key % 30 == 0, "nan").otherwise(F.concat(F.col("l_partkey").cast("string"), F.lit(".0"))).alias("code_insee"),
        "commune",
        F.concat(F.col("l_suppkey").cast("string"), F.lit(".0")).alias("code_postal"),
        F.year("l_shipdate").alias("year"),
    )


@query(
    "silver_transactions",
    f"""WITH {RAW_SALES}, {TYPED_SALES}
    SELECT strftime(date_mutation, '%Y-%m-%d') AS date_mutation, valeur_fonciere, surface_reelle_bati, nombre_pieces,
           type_local, code_commune, nom_commune, code_postal, rnd(prix_m2, 4) AS prix_m2, source, year FROM clean""",
)
def silver_transactions(spark, folder):
    """All-text sales through alias resolution, coercion, validity filter and exact dedup."""
    raw = _raw_sales(spark, folder)
    resolved = columns.resolve_columns(raw, silver.SALE_COLUMNS | {"year": ["year"]})
    cleaned = silver.clean_sales(resolved, F.col("year"))
    return rounded(cleaned.withColumn("date_mutation", F.date_format("date_mutation", "yyyy-MM-dd")))


@query(
    "silver_clean_numeric",
    f"""WITH {RAW_SALES} SELECT valeur_fonciere, count(*) AS n,
        max(CASE WHEN regexp_matches(valeur_fonciere, '[0-9.]$')
            THEN TRY_CAST(replace(replace(valeur_fonciere, ',', '.'), ' ', '') AS DOUBLE) END) AS valeur,
        max(TRY_CAST(replace(surface_reelle_bati, ' ', '') AS DOUBLE)) AS surface_max
    FROM raw GROUP BY valeur_fonciere""",
)
def silver_clean_numeric(spark, folder):
    return _raw_sales(spark, folder).groupBy("valeur_fonciere").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(c.to_number(F.col("valeur_fonciere"))).alias("valeur"),
        F.max(c.to_number(F.col("surface_reelle_bati"))).alias("surface_max"),
    )


_NAME = "upper(p_name) || '-l''' || p_type || ' ' || p_brand"


@query("title_case_names", f"SELECT p_partkey, {TITLE.format(_NAME)} AS nom FROM part")
def title_case_names(spark, folder):
    raw = F.concat(F.upper("p_name"), F.lit("-l'"), F.col("p_type"), F.lit(" "), F.col("p_brand"))
    return S.table(spark, folder, "part").select("p_partkey", c.title_case(raw).alias("nom"))


_DEPT = "CASE WHEN d3 LIKE '97%' OR d3 LIKE '98%' THEN substr(d3, 1, 3) ELSE substr(d3, 1, 2) END"


@query(
    "code_functions",
    f"""WITH t AS (SELECT c_custkey, lpad(CAST((c_custkey * 977) % 100000 AS VARCHAR), 5, '0') AS d3, c_name FROM customer)
    SELECT c_custkey, {_DEPT} AS departement,
           CASE WHEN d3 LIKE '97%' THEN rpad({_DEPT}, 5, '0') ELSE ({_DEPT}) || '000' END AS postal,
           trim(regexp_replace(lower(trim(c_name)), '[^a-z0-9]+', '-', 'g'), '-') AS slug,
           CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE d3 END AS premier_postal FROM t""",
)
def code_functions(spark, folder):
    """Department, fallback postal code, slug and first postal of a list."""
    code = F.lpad(((F.col("c_custkey") * 977) % 100_000).cast("string"), 5, "0")
    listed = F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.concat(code, F.lit(",99999")))
    dept = c.department_of(code)
    return S.table(spark, folder, "customer").select(
        "c_custkey", dept.alias("departement"), c.fallback_postal(dept).alias("postal"),
        c.slug(F.col("c_name")).alias("slug"), c.first_postal(listed).alias("premier_postal"),
    )


VIEW = """commune_year AS (
    SELECT c.code_commune, c.nom_commune, c.population, CAST(year(date_mutation) AS INTEGER) AS year,
           count(*) AS transaction_count, avg(valeur_fonciere) AS avg_price, avg(prix_m2) AS avg_price_m2,
           quantile_cont(prix_m2, 0.5) AS median_price_m2, avg(surface_reelle_bati) AS avg_surface
    FROM sales s JOIN communes c ON c.code_commune = s.code_commune WHERE prix_m2 IS NOT NULL GROUP BY 1, 2, 3, 4)"""
MART_INPUTS = f"{S.SALES}, {S.COMMUNES}, {VIEW}"
MART = f"""{MART_INPUTS}, {S.DEPARTMENTS}, {S.REGIONS}, mart AS (
    SELECT code_commune, nom_commune, population, year, transaction_count, {S.round_sql('avg_price', 2)} AS avg_price,
           {S.round_sql('avg_price_m2', 2)} AS avg_price_m2, {S.round_sql('median_price_m2', 2)} AS median_price_m2,
           {S.round_sql('avg_surface', 2)} AS avg_surface FROM commune_year)"""
STAR = """mart m JOIN communes c ON c.code_commune = m.code_commune
    JOIN departements d ON d.code_departement = c.code_departement JOIN regions r ON r.code_region = d.code_region"""


def _mart(spark, folder):
    mart = G.commune_mart(S.sales(spark, folder), S.communes(spark, folder))
    return mart.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in mart.dtypes])


def _geo(spark, folder):
    return S.communes(spark, folder), S.departments(spark, folder), S.regions(spark, folder)


@query(
    "commune_year_view",
    f"""WITH {MART_INPUTS} SELECT code_commune, nom_commune, year, transaction_count,
        {S.round_sql('avg_price', 2)} AS avg_price, {S.round_sql('avg_price_m2', 2)} AS avg_price_m2,
        {S.round_sql('median_price_m2', 2)} AS median_price_m2 FROM commune_year""",
)
def commune_year_view(spark, folder):
    view = G.sql_view(S.sales(spark, folder), S.communes(spark, folder))
    return view.select(*[F.col(n).cast("double").alias(n) if t.startswith("decimal") else F.col(n) for n, t in view.dtypes])


@query("dbt_mart", f"WITH {MART} SELECT * FROM mart")
def dbt_mart(spark, folder):
    return _mart(spark, folder)


@query("latest_year_avg", f"""WITH {MART} SELECT rnd(avg(avg_price_m2), 0) AS prix_moyen FROM mart
    WHERE year = (SELECT max(year) FROM mart)""")
def latest_year_avg(spark, folder):
    return G.latest_year_average(_mart(spark, folder))


@query(
    "region_year_series",
    f"""WITH {MART} SELECT strftime(make_date(m.year, 1, 1), '%Y-%m-%d') AS time, rnd(avg(avg_price_m2), 0) AS prix_moyen,
        rnd(quantile_cont(avg_price_m2, 0.5), 0) AS prix_median FROM {STAR} WHERE r.nom_region LIKE 'A%' GROUP BY 1""",
)
def region_year_series(spark, folder):
    series = G.region_year_series(_mart(spark, folder), *_geo(spark, folder), region="A%")
    return series.withColumn("time", F.date_format("time", "yyyy-MM-dd"))


@query(
    "dept_top12",
    f"""WITH {MART} SELECT nom_departement, rnd(avg(avg_price_m2), 0) AS prix_m2 FROM {STAR}
        WHERE m.year = (SELECT max(year) FROM mart) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""",
)
def dept_top12(spark, folder):
    return G.top_departments(_mart(spark, folder), *_geo(spark, folder))


@query(
    "coverage_per_year",
    f"""WITH {MART} SELECT year, count(*) AS communes_couvertes, rnd(avg(transaction_count), 0) AS transactions_moy,
        rnd(avg(avg_price_m2), 0) AS prix_moyen FROM mart GROUP BY year""",
)
def coverage_per_year(spark, folder):
    return G.coverage_per_year(_mart(spark, folder))


@query("filtered_ratio", f"""WITH {S.COMMUNES} SELECT
    rnd(100.0 * count(*) FILTER (latitude IS NOT NULL) / nullif(count(*), 0), 1) AS geocodage_pct FROM communes""")
def filtered_ratio(spark, folder):
    return aggregates.filled_share(S.communes(spark, folder), "latitude", "geocodage_pct")


@query(
    "orphan_codes",
    f"""WITH {S.SALES}, {S.INCOMES} SELECT s.code_commune, s.nom_commune, count(*) AS lignes
        FROM sales s LEFT JOIN incomes i ON i.code_commune = s.code_commune WHERE i.code_commune IS NULL GROUP BY 1, 2""",
)
def orphan_codes(spark, folder):
    return joins.orphans(S.sales(spark, folder), S.incomes(spark, folder))


@query(
    "global_stats",
    f"""WITH {MART} SELECT 'communes' AS "table", count(*) AS lignes FROM communes UNION ALL
        SELECT 'mart_commune_real_estate', count(*) FROM mart UNION ALL SELECT 'regions', count(*) FROM regions""",
)
def global_stats(spark, folder):
    return aggregates.table_volumes(
        {
            "communes": S.communes(spark, folder),
            "mart_commune_real_estate": _mart(spark, folder),
            "regions": S.regions(spark, folder),
        }
    )


@query(
    "mean_growth",
    f"WITH {S.SALES}, {S.GOLD} SELECT rnd(avg(price_m2_yoy_variation), 4) AS croissance FROM gold",
)
def mean_growth(spark, folder):
    return aggregates.mean_of(S.gold(spark, folder), "price_m2_yoy_variation", 4, "croissance")


_HISTORY = """history AS (SELECT code_commune, year AS annee, avg_price_m2, 'constate' AS serie FROM gold),
predicted AS (SELECT code_commune, 2003 AS annee, avg(avg_price_m2) * 1.03 AS avg_price_m2 FROM gold GROUP BY 1)"""


@query(
    "price_history",
    f"""WITH {S.SALES}, {S.GOLD}, {_HISTORY}
    SELECT code_commune, CAST(annee AS INTEGER) AS annee, rnd(avg_price_m2, 4) AS avg_price_m2, serie FROM history
    UNION ALL SELECT code_commune, annee, rnd(avg_price_m2, 4), 'prediction' FROM predicted
    WHERE code_commune IN (SELECT code_commune FROM history GROUP BY 1 HAVING count(*) >= 2)""",
)
def price_history(spark, folder):
    gold = S.gold(spark, folder)
    predictions = gold.groupBy("code_commune").agg(
        F.lit(2003).alias("target_year"), (F.avg("avg_price_m2") * 1.03).alias("predicted_avg_price_m2")
    )
    return rounded(G.price_history(gold, predictions))


@query(
    "star_sales",
    f"""WITH {S.SALES}, {S.INCOMES} SELECT strftime(date_mutation, '%Y-%m-%d') AS date_mutation,
        {S.round_sql('valeur_fonciere', 2)} AS valeur_fonciere, {S.round_sql('surface_reelle_bati', 2)} AS surface_reelle_bati,
        nombre_pieces, type_local, code_commune, {S.round_sql('prix_m2', 2)} AS prix_m2, source
    FROM sales WHERE code_commune IN (SELECT code_commune FROM incomes)""",
)
def star_sales(spark, folder):
    """Fact rows of the star schema; sales of unknown communes are dropped."""
    rows = star.star_sales(S.sales(spark, folder), S.incomes(spark, folder))
    return rows.withColumns(
        {
            "date_mutation": F.date_format("date_mutation", "yyyy-MM-dd"),
            **{n: F.col(n).cast("double") for n in ("valeur_fonciere", "surface_reelle_bati", "prix_m2")},
        }
    )


@query(
    "star_unmapped",
    f"""WITH {S.SALES}, {S.INCOMES} SELECT count(*) AS ventes_ecartees FROM sales
        WHERE code_commune NOT IN (SELECT code_commune FROM incomes)""",
)
def star_unmapped(spark, folder):
    return star.unmapped(S.sales(spark, folder), S.incomes(spark, folder))


@query(
    "star_communes",
    f"""WITH {S.COMMUNES}, {S.DEPARTMENTS} SELECT code_commune, nom_commune, split_part(codes_postaux, ',', 1) AS code_postal,
        d.code_departement, latitude, longitude, population
        FROM communes c LEFT JOIN departements d ON d.code_departement = c.code_departement""",
)
def star_communes(spark, folder):
    return star.star_communes(S.communes(spark, folder), S.departments(spark, folder))


@query(
    "bi_extract",
    f"""WITH {S.SALES}, {S.GOLD} SELECT nom_commune, code_commune, year, transaction_count, rnd(avg_price, 4) AS avg_price,
        rnd(avg_price_m2, 4) AS avg_price_m2, rnd(median_price_m2, 4) AS median_price_m2,
        rnd(avg_surface, 4) AS avg_surface, CAST(NULL AS INTEGER) AS population FROM gold""",
)
def bi_extract(spark, folder):
    return rounded(star.bi_mart(S.gold(spark, folder)))


@query(
    "staging_communes",
    f"WITH {S.COMMUNES} SELECT code_commune AS commune_id, code_commune, nom_commune, code_departement, latitude, longitude, population FROM communes",
)
def staging_communes(spark, folder):
    return columns.staging_communes(S.communes(spark, folder))


@query(
    "real_estate_stats",
    f"WITH {S.SALES}, {S.GOLD} {GOLD_ROUNDED} WHERE code_commune = '00042' ORDER BY year DESC",
)
def real_estate_stats(spark, folder):
    return rounded(serving.real_estate_stats(S.gold(spark, folder), "00042"), price_m2_yoy_variation=6)




@query(
    "price_points",
    f"""WITH {MART} SELECT m.code_commune, c.latitude, c.longitude, rnd(m.avg_price_m2, 0) AS prix_m2 FROM mart m JOIN communes c USING (code_commune)
        WHERE m.year = (SELECT max(year) FROM mart) AND c.latitude IS NOT NULL ORDER BY m.code_commune LIMIT 3000""",
)
def price_points(spark, folder):
    return rounded(serving.price_points(_mart(spark, folder), S.communes(spark, folder)), 4, prix_m2=0)


@query(
    "region_median_sketch",
    f"""WITH {S.SALES}, {S.COMMUNES}, {S.DEPARTMENTS}, {S.REGIONS} SELECT r.nom_region, s.year, count(*) AS transaction_count,
        true AS within_bound FROM sales s JOIN communes c USING (code_commune) JOIN departements d USING (code_departement)
        JOIN regions r ON r.code_region = d.code_region WHERE s.prix_m2 BETWEEN 200 AND 30000 GROUP BY 1, 2""",
)
def region_median_sketch(spark, folder):
    """Medians by region and year merged from commune sketches, held against the exact ranks of all prices."""
    communes, departments, regions = _geo(spark, folder)
    place = communes.select("code_commune", "code_departement").join(
        departments.select("code_departement", "code_region"), "code_departement"
    ).join(regions.select("code_region", "nom_region"), "code_region").select("code_commune", "nom_region")
    sales = S.sales(spark, folder)
    sketches = stored(G.price_sketches(sales), "price-sketches").join(place, "code_commune")
    medians = G.merged_medians(sketches, ["nom_region", "year"])
    prices = filters.plausible_prices(sales).select("code_commune", "year", "prix_m2").join(place, "code_commune")
    price, median, n = F.col("prix_m2"), F.col("median_price_m2"), F.col("transaction_count")
    ranks = prices.join(medians, ["nom_region", "year"]).groupBy("nom_region", "year", "transaction_count").agg(
        F.count_if(price < median).alias("below"), F.count_if(price <= median).alias("up_to")
    )
    within = (F.col("below") <= n * (0.5 + G.SKETCH_ERROR) + 1) & (F.col("up_to") >= n * (0.5 - G.SKETCH_ERROR) - 1)
    return ranks.select("nom_region", "year", "transaction_count", within.alias("within_bound"))


@query(
    "bronze_union",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority ELSE o_orderpriority || chr(10) || '"' || o_orderstatus || '"; ' || o_orderkey END AS note,
       CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS statut, o_totalprice AS prix FROM orders""",
)
def bronze_union(spark, folder):
    """Three folders of CSV files: swapped headers, other delimiters, gzip, quoted breaks, quotes and delimiters; joined by name."""
    place = f"{work_folder(spark)}/csv-{uuid.uuid4().hex}"
    orders = S.table(spark, folder, "orders")
    key, price, status = F.col("o_orderkey"), F.col("o_totalprice").alias("prix"), F.col("o_orderstatus").alias("statut")
    long_note = F.concat("o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('"; '), key.cast("string")).alias("note")
    layouts = [
        (["o_orderkey", price, status], {"sep": ";"}),
        ([price, "o_orderkey", F.col("o_orderpriority").alias("note")], {"sep": ",", "compression": "gzip"}),
        ([status, long_note, price, "o_orderkey"], {"sep": "\t", "quoteAll": True}),
    ]
    for k, (columns_, options) in enumerate(layouts):
        orders.where(key % 3 == k).select(*columns_).write.options(header=True, escape='"', **options).csv(f"{place}/{k}")
    rows = files.read_csv_flexible(spark, [f"{place}/{k}" for k in range(3)])
    return rows.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "note", "statut", F.col("prix").cast("double").alias("prix"))
