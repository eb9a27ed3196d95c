"""Rental investment: loan table, metrics, risk, capacity, projection, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions import finance as fin
from parcelle.operators import filters, invest, joins, scoring
from parcelle.operators.dedup import top_per_key
from parcelle.plans import serving
from parcelle.session import fan_out, stored
from parcelle.workloads import standins as S
from parcelle.workloads.registry import query, rounded

_QUALITY = {"transport_score": 1, "green_score": 1, "services_score": 1,
            "network_score": 1, "education_score": 1, "health_score": 1}


def _brackets(x: str, brackets, top) -> str:
    return "CASE " + " ".join(f"WHEN {x} < {b} THEN {v}::DOUBLE" for b, v in brackets) + f" ELSE {top}::DOUBLE END"


def _factor(rate: str, years: str) -> str:
    """Monthly instalment per euro."""
    return (f"(CASE WHEN {rate} = 0 THEN 1.0::DOUBLE / ({years} * 12) ELSE ({rate} / 1200.0::DOUBLE) / "
            f"(1 - power(1 + {rate} / 1200.0::DOUBLE, -({years}) * 12)) END)")


@query(
    "annuity_table",
    f"""WITH t AS (SELECT c_custkey, c_acctbal * 100 AS principal, CAST(c_custkey % 6 AS DOUBLE) AS taux, [10, 15, 20, 25, 30][c_custkey % 5 + 1] AS duree,
            18 + c_custkey % 60 AS age FROM customer)
    SELECT c_custkey, rnd(principal * {_factor('taux', 'duree')}, 4) AS mensualite,
        {_brackets('age', P.INSURANCE_BRACKETS, P.INSURANCE_TOP)} AS assurance, {_brackets('principal / 100', P.YIELD_BRACKETS, P.YIELD_TOP)} AS rendement,
        rnd(greatest(CASE WHEN taux = 0 THEN principal * (1 - 60.0::DOUBLE / (duree * 12)) ELSE principal * power(1 + taux / 1200, 60)
            - principal * {_factor('taux', 'duree')} * (power(1 + taux / 1200, 60) - 1) / (taux / 1200) END, 0), 4) AS dette_5_ans
    FROM t""",
)
def annuity_table(spark, folder):
    key = F.col("c_custkey")
    years = F.element_at(F.array(*[F.lit(y) for y in P.MARKET_RATES]), (key % 5 + 1).cast("int"))
    principal, rate = F.col("c_acctbal") * 100, (key % 6).cast("double")
    return rounded(S.table(spark, folder, "customer").select(
        "c_custkey", fin.annuity(principal, rate, years).alias("mensualite"),
        fin.insurance_rate(key % 60 + 18).alias("assurance"), fin.gross_yield(F.col("c_acctbal")).alias("rendement"),
        fin.remaining_debt(principal, rate, years, 60).alias("dette_5_ans"),
    ))


# Commune table with prices, rents, tax and population: the input of the metrics.
_INPUT = f"""{S.SALES}, {S.GOLD}, {S.PRICES}, {S.COMMUNES}, {S.RENTS}, {S.PROPERTY_TAX}, input AS (
    SELECT c.code_commune, c.nom_commune, c.code_departement, c.population, p.avg_price_m2, p.transaction_count,
           p.price_m2_yoy_variation AS annual_price_growth, r.* EXCLUDE (code_commune), t.taux_tfb_dept, t.vl_m2_commune
    FROM communes c JOIN prices p USING (code_commune) LEFT JOIN rents r ON r.code_commune = c.code_commune
    LEFT JOIN property_tax t ON t.code_commune = c.code_commune)"""


def _input(spark, folder):
    base = joins.communes_with_prices(
        S.communes(spark, folder).select("code_commune", "nom_commune", "code_departement", "population"),
        S.prices(spark, folder).select(
            "code_commune", "avg_price_m2", "transaction_count", F.col("price_m2_yoy_variation").alias("annual_price_growth")
        ),
    )
    return base.join(S.rents(spark, folder), "code_commune", "left").join(S.property_tax(spark, folder), "code_commune", "left")


def _metrics_sql(surface=45, rent="loyer_m2_app12", regime=0) -> str:
    tax_share = "0.472::DOUBLE"
    base = [
        f"greatest(rent12 - charges_tot_annuelles - interets_annuels - prix_bien_possible * 0.025::DOUBLE - 1000, 0) * {tax_share}",
        f"rent12 * 0.5::DOUBLE * {tax_share}",
        f"greatest(rent12 - charges_tot_annuelles - interets_annuels, 0) * {tax_share}",
        f"rent12 * 0.7::DOUBLE * {tax_share}",
    ][regime]
    gross = _brackets("avg_price_m2", P.YIELD_BRACKETS, P.YIELD_TOP)
    return f"""m1 AS (SELECT *, avg_price_m2 * {surface} AS prix_bien_possible, {gross} AS rendement_brut,
        CASE WHEN {rent} > 0 THEN {rent} * {surface} ELSE avg_price_m2 * {surface} * ({gross}) / 1200 END * 1.15::DOUBLE AS loyer_theorique,
        CASE WHEN loyer_m2_app > 0 THEN 'ANIL 2024' ELSE 'Estimation' END AS loyer_source,
        rnd(coalesce(vl_m2_commune, coalesce(loyer_m2_app, avg_price_m2 * 0.004::DOUBLE) * 0.5::DOUBLE) * {surface} * 12
            * (coalesce(taux_tfb_dept, 22.5) / 100), 0) AS taxe_fonciere_estimee FROM input),
    m2 AS (SELECT *, loyer_theorique AS loyer_estime, loyer_theorique * 0.95::DOUBLE AS loyer_encaisse,
        1700 + taxe_fonciere_estimee AS charges_tot_annuelles, prix_bien_possible * 1.075::DOUBLE + 6500 AS cout_acquisition_total FROM m1),
    m3 AS (SELECT *, greatest(cout_acquisition_total - 15000, 0) AS montant_emprunte, loyer_encaisse * 12 AS rent12 FROM m2),
    m4 AS (SELECT *, montant_emprunte * ({_factor('3.65::DOUBLE', '20')} + 0.1::DOUBLE / 1200) AS mensualite_commune,
        montant_emprunte * 0.0365::DOUBLE AS interets_annuels FROM m3),
    m5 AS (SELECT *, {base} AS impot_annuel, rent12 / 12 - mensualite_commune - charges_tot_annuelles / 12 AS cashflow_mensuel FROM m4),
    metrics AS (SELECT *, cashflow_mensuel - impot_annuel / 12 AS cashflow_net_fiscal,
        greatest((rent12 - charges_tot_annuelles) / greatest(cout_acquisition_total, 1) * 100, 0) AS rendement_net,
        greatest((rent12 - charges_tot_annuelles - impot_annuel) / greatest(cout_acquisition_total, 1) * 100, 0) AS rendement_net_fiscal FROM m5)"""


_NUMBERS = ["prix_bien_possible", "loyer_theorique", "loyer_estime", "loyer_encaisse", "taxe_fonciere_estimee", "charges_tot_annuelles",
            "cout_acquisition_total", "montant_emprunte", "mensualite_commune", "interets_annuels", "impot_annuel",
            "cashflow_mensuel", "cashflow_net_fiscal", "rendement_brut", "rendement_net", "rendement_net_fiscal"]
_LISTED = ", ".join(f"rnd({c}, 4) AS {c}" for c in _NUMBERS)


@query("rental_metrics", f"WITH {_INPUT}, {_metrics_sql()} SELECT code_commune, loyer_source, {_LISTED} FROM metrics")
def rental_metrics(spark, folder):
    return rounded(invest.rental_metrics(_input(spark, folder)).select("code_commune", "loyer_source", *_NUMBERS))


def _regime_query(name: str, regime: int):
    @query(name, f"WITH {_INPUT}, {_metrics_sql(70, 'loyer_m2_app3', regime)} SELECT code_commune, {_LISTED} FROM metrics")
    def run(spark, folder):
        chosen = invest.Project(surface=70, regime=P.REGIMES[regime])
        return rounded(invest.rental_metrics(_input(spark, folder), chosen).select("code_commune", *_NUMBERS))

    return run


_regime_query("rental_metrics_micro_bic", 1)
_regime_query("rental_metrics_bare_real", 2)
_regime_query("rental_metrics_micro_foncier", 3)

_RISK = """risk AS (SELECT *, CASE WHEN points >= 6 THEN 3 WHEN points >= 4 THEN 2 WHEN points >= 2 THEN 1 ELSE 0 END AS risque_vacance FROM (
    SELECT *, CASE WHEN coalesce(population, 0) < 500 THEN 3 WHEN population < 2000 THEN 2 WHEN population < 10000 THEN 1 ELSE 0 END
        + CASE WHEN coalesce(loyer_m2_app, 0) = 0 THEN 2 ELSE 0 END
        + CASE WHEN coalesce(transaction_count, 0) < 3 THEN 2 WHEN transaction_count < 10 THEN 1 ELSE 0 END AS points FROM {0}))"""
_LEVEL = "CASE risque_vacance " + " ".join(f"WHEN {n} THEN {{{n}}}" for n in range(4)) + " END"
_LABEL = _LEVEL.format(*[f"'{label}'" for _, label, _ in P.VACANCY_LEVELS])
_SHARE = _LEVEL.format(*[f"{share}::DOUBLE" for *_, share in P.VACANCY_LEVELS])


@query(
    "vacancy_risk",
    f"""WITH {_INPUT}, {_RISK.format('input')} SELECT code_commune, CAST(risque_vacance AS INTEGER) AS risque_vacance, {_LABEL} AS vacance_label,
        {_SHARE} AS taux_vacance, coalesce(nullif(concat_ws(' · ', CASE WHEN coalesce(population, 0) < 500 THEN
            'Population : ' || CAST(coalesce(population, 0) AS VARCHAR) || ' hab.' END,
            CASE WHEN coalesce(loyer_m2_app, 0) = 0 THEN 'Aucune donnée de loyer ANIL' END,
            CASE WHEN coalesce(transaction_count, 0) < 10 THEN 'Seulement ' || CAST(coalesce(transaction_count, 0) AS VARCHAR) || ' ventes DVF/an' END), ''),
            'Indicateurs favorables') AS detail_vacance, rnd({_SHARE} * 12, 1) AS mois_vacance FROM risk""",
)
def vacancy_risk(spark, folder):
    return invest.vacancy_risk(_input(spark, folder)).select(
        "code_commune", "risque_vacance", "vacance_label", "taux_vacance", "detail_vacance", "mois_vacance"
    )


_CAP = f"""profiles AS (SELECT c_custkey, greatest(c_acctbal, 0) + 1200 AS salaire_net, CAST(c_custkey % 3 * 100 AS DOUBLE) AS autres_revenus,
        CAST(c_custkey % 7 * 150 AS DOUBLE) AS mensualites_existantes, CAST(c_nationkey * 1000 AS DOUBLE) AS apport, 20 + c_custkey % 50 AS age,
        [10, 15, 20, 22, 25, 30][c_custkey % 6 + 1] AS duree FROM customer),
    rated AS (SELECT *, CASE duree {' '.join(f'WHEN {y} THEN {r}::DOUBLE' for y, r in P.MARKET_RATES.items())} ELSE 3.65::DOUBLE END AS taux,
        {_brackets('age', P.INSURANCE_BRACKETS, P.INSURANCE_TOP)} AS taux_assurance,
        greatest((salaire_net + autres_revenus) * 0.35::DOUBLE - mensualites_existantes, 0) AS mensualite_max FROM profiles),
    capacity AS (SELECT *, mensualite_max / ({_factor('taux', 'duree')} + taux_assurance / 1200) AS capacite_emprunt FROM rated)"""


@query(
    "borrow_capacity",
    f"""WITH {_CAP} SELECT c_custkey, rnd(mensualite_max, 4) AS mensualite_max, rnd(capacite_emprunt, 4) AS capacite_emprunt,
        rnd(greatest((capacite_emprunt + apport - 6500) / 1.075::DOUBLE, 0), 4) AS prix_max_bien,
        rnd(capacite_emprunt * taux_assurance / 1200, 4) AS mensualite_assurance,
        rnd(capacite_emprunt * ({_factor('taux', 'duree')} + taux_assurance / 1200), 4) AS mensualite_totale FROM capacity""",
)
def borrow_capacity(spark, folder):
    key = F.col("c_custkey")
    profiles = S.table(spark, folder, "customer").select(
        "c_custkey", (F.greatest("c_acctbal", F.lit(0.0)) + 1200).alias("salaire_net"),
        (key % 3 * 100).cast("double").alias("autres_revenus"), (key % 7 * 150).cast("double").alias("mensualites_existantes"),
        (F.col("c_nationkey") * 1000).cast("double").alias("apport"), (key % 50 + 20).alias("age"),
        F.element_at(F.array(*[F.lit(y) for y in (10, 15, 20, 22, 25, 30)]), (key % 6 + 1).cast("int")).alias("duree"),
    )
    return rounded(invest.borrow_capacity(profiles).select(
        "c_custkey", "mensualite_max", "capacite_emprunt", "prix_max_bien", "mensualite_assurance", "mensualite_totale"
    ))


@query(
    "budget_filter",
    f"""WITH {_INPUT}, {_metrics_sql()} SELECT code_commune, rnd(cout_acquisition_total, 4) AS cout_acquisition_total,
        cashflow_mensuel >= 0 AS autofinancee FROM metrics WHERE cout_acquisition_total <= 250000 * 1.1 AND coalesce(transaction_count, 0) >= 10""",
)
def budget_filter(spark, folder):
    affordable = filters.within_budget(invest.rental_metrics(_input(spark, folder)), 250_000)
    kept = filters.reliable(affordable, 10)
    return rounded(filters.self_financing(kept).select("code_commune", "cout_acquisition_total", "autofinancee"))


@query(
    "market_labels",
    f"""WITH {_INPUT} SELECT code_commune, CASE WHEN loyer_m2_app > 0 AND nb_annonces_app >= 5 THEN '✓' WHEN loyer_m2_app > 0 THEN '~' ELSE '*' END AS confiance_loyer,
        CASE WHEN nb_annonces_app >= 30 THEN CAST(nb_annonces_app AS VARCHAR) || ' annonces 🔥' WHEN nb_annonces_app >= 5 THEN CAST(nb_annonces_app AS VARCHAR) || ' annonces'
             WHEN nb_annonces_app > 0 THEN CAST(nb_annonces_app AS VARCHAR) || ' annonce(s) — loyer estimé'
             WHEN loyer_m2_app > 0 THEN '< 5 annonces — loyer estimé' ELSE 'Pas de données ANIL — loyer calculé' END AS marche_locatif,
        rnd(CASE WHEN abs(annual_price_growth) <= 0.2 THEN annual_price_growth END, 6) AS evolution_affichee FROM input""",
)
def market_labels(spark, folder):
    labels = invest.market_labels(_input(spark, folder))
    return rounded(labels.select("code_commune", "confiance_loyer", "marche_locatif", "evolution_affichee"), 6)


_SCENARIOS = ", ".join(f"('{n}', {r}::DOUBLE, {c}::DOUBLE, {g}::DOUBLE)" for n, (r, c, g) in P.SCENARIOS.items())
_PROJECTED = ["loyer_annuel", "charges", "credit", "impot", "cashflow", "cashflow_cumule", "dette", "valeur", "patrimoine_net", "net_revente"]


@query(
    "projection_table",
    f"""WITH {_INPUT}, {_metrics_sql()}, {_RISK.format('metrics')}, scenarios(scenario, rp, cp, gp) AS (VALUES {_SCENARIOS}),
    years AS (SELECT code_commune, scenario, CAST(annee AS INTEGER) AS annee, gp, prix_bien_possible, montant_emprunte,
        loyer_estime * 12 * power(1 + rp / 100, annee - 1) AS loyer, {_SHARE} AS vide,
        charges_tot_annuelles * power(1 + cp / 100, annee - 1) AS charges,
        CASE WHEN annee < 20 THEN mensualite_commune * 12 ELSE 0 END AS credit,
        greatest(montant_emprunte * power(1 + 3.65::DOUBLE / 1200, annee * 12) - montant_emprunte * {_factor('3.65::DOUBLE', '20')}
            * (power(1 + 3.65::DOUBLE / 1200, annee * 12) - 1) / (3.65::DOUBLE / 1200), 0) AS dette,
        prix_bien_possible * power(1.01::DOUBLE, annee) AS valeur
        FROM risk, scenarios, (SELECT unnest(generate_series(1, 20)) AS annee)),
    taxed AS (SELECT *, loyer * (1 - vide) AS loyer_annuel,
        greatest(loyer - charges - dette * 0.0365::DOUBLE - prix_bien_possible * 0.025::DOUBLE - 1000, 0) * 0.472::DOUBLE AS impot FROM years),
    flows AS (SELECT *, loyer_annuel - credit - charges - impot AS cashflow FROM taxed),
    summed AS (SELECT *, sum(cashflow) OVER (PARTITION BY code_commune, scenario ORDER BY annee) AS cashflow_cumule FROM flows)
    SELECT code_commune, scenario, annee, {', '.join(f'rnd({c}, 2) AS {c}' for c in _PROJECTED[:8])},
        rnd(valeur - dette + cashflow_cumule, 2) AS patrimoine_net,
        rnd(valeur - dette - greatest(valeur - prix_bien_possible, 0) * gp / 100, 2) AS net_revente FROM summed""",
)
def projection_table(spark, folder):
    # written first, so that no figure is worked out again for each year; few rows that unfold to many are spread before, since
    # the projection itself shuffles nothing
    metrics = stored(invest.vacancy_risk(invest.rental_metrics(_input(spark, folder))), "rental-metrics")
    return rounded(invest.project(fan_out(metrics, "code_commune")), 2)


@query(
    "best_per_department",
    f"""WITH {_INPUT}, {_metrics_sql()} SELECT code_departement, code_commune, rnd(cashflow_mensuel, 4) AS cashflow_mensuel FROM (
        SELECT *, row_number() OVER (PARTITION BY code_departement ORDER BY cashflow_mensuel DESC, code_commune) AS p FROM metrics) WHERE p = 1""",
)
def best_per_department(spark, folder):
    best = serving.best_per_department(invest.rental_metrics(_input(spark, folder)))
    return rounded(best.select("code_departement", "code_commune", "cashflow_mensuel"))


@query(
    "map_points",
    f"""WITH {_INPUT}, {_metrics_sql()} SELECT code_commune, population, rnd(greatest(least(cashflow_mensuel, 500), -500), 4) AS cashflow_affiche
        FROM metrics ORDER BY population DESC NULLS LAST, code_commune LIMIT 3000""",
)
def map_points(spark, folder):
    points = serving.map_points(invest.rental_metrics(_input(spark, folder)))
    return rounded(points.select("code_commune", "population", "cashflow_affiche"))


@query(
    "map_points_department",
    f"""WITH {_INPUT}, {_metrics_sql()}, shown AS (SELECT code_commune, greatest(least(cashflow_mensuel, 500), -500) AS c FROM metrics
            WHERE code_departement = '07' ORDER BY population DESC NULLS LAST, code_commune LIMIT 3000)
        SELECT code_commune, rnd(c, 4) AS cashflow_affiche, row_number() OVER (ORDER BY c, code_commune) AS place FROM shown""",
)
def map_points_department(spark, folder):
    """One department in the order of drawing."""
    points = serving.map_points(invest.rental_metrics(_input(spark, folder)), department="07")
    # of one sorted partition of at most the map's limit
    placed = points.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)
    return rounded(placed.select("code_commune", "cashflow_affiche", "place"))


@query(
    "investor_pool",
    f"""WITH {_INPUT}, {_metrics_sql()}, {_RISK.format('metrics')} SELECT code_commune, CAST(risque_vacance AS INTEGER) AS risque_vacance,
        rnd(rendement_net_fiscal, 4) AS rendement_net_fiscal FROM risk
        WHERE cashflow_net_fiscal >= -2000 AND rendement_net_fiscal >= 0.5 AND prix_bien_possible BETWEEN 20000 AND 400000
          AND risque_vacance IN (0, 1, 2) AND coalesce(loyer_m2_app, 0) > 0""",
)
def investor_pool(spark, folder):
    metrics = invest.vacancy_risk(invest.rental_metrics(_input(spark, folder)))
    pool = serving.investor_pool(
        metrics, min_cashflow=-2_000, min_yield=0.5, price_range=(20_000, 400_000),
        vacancy_levels=[0, 1, 2], only_observed_rent=True,
    )
    return rounded(pool.select("code_commune", "risque_vacance", "rendement_net_fiscal"))


_Q = " + ".join(f"{c} / 6.0::DOUBLE" for c in _QUALITY)


def _final(name):
    return f"{S.rank_sql(name)} AS score_{name}"


@query(
    "investor_final_score",
    f"""WITH {S.TERRITORY_ALL}, input AS (SELECT * FROM territory), {_metrics_sql()}, {_RISK.format('metrics')},
    rounded AS (SELECT code_commune, rnd(cashflow_net_fiscal, 6) - rnd(loyer_estime, 6) * rnd({_SHARE}, 6) AS cf,
        rnd(rendement_net_fiscal, 6) * (1 - rnd({_SHARE}, 6)) AS rdt, rnd({_Q}, 6) AS qdv FROM risk),
    ranked AS (SELECT code_commune, {_final('cf')}, {_final('rdt')}, {_final('qdv')} FROM rounded)
    SELECT code_commune, rnd(score_cf, 6) AS score_cf, rnd(score_rdt, 6) AS score_rdt, rnd(score_qdv, 6) AS score_qdv, rnd((score_cf * 4 / 7 + score_rdt * 3 / 7) * 0.7::DOUBLE + score_qdv * 0.3::DOUBLE, 4) AS score_final FROM ranked""",
)
def investor_final_score(spark, folder):
    """Inputs are rounded first: a rank must not hang on the last digit of a double."""
    read = ["population", "avg_price_m2", "transaction_count", "loyer_m2_app", "loyer_m2_app12", "loyer_m2_app3", "taux_tfb_dept",
            "vl_m2_commune", "code_departement", "nb_annonces_app", *_QUALITY]
    table = S.territory(spark, folder, keep=True, columns=read)
    metrics = invest.vacancy_risk(invest.rental_metrics(scoring.with_quality(table, _QUALITY)))
    pool = rounded(metrics.select(
        "code_commune", "cashflow_net_fiscal", "rendement_net_fiscal", "critere_score", "taux_vacance", "loyer_estime"
    ), 6)
    scored = scoring.investor_scores(pool)
    return rounded(
        scored.select("code_commune", "score_cf", "score_rdt", "score_qdv", "score_final"), 6, score_final=4
    )


@query(
    "top_per_department",
    f"""WITH {S.COMMUNES} SELECT code_departement, code_commune, population FROM (SELECT *, row_number() OVER (PARTITION BY code_departement
        ORDER BY population DESC NULLS LAST, code_commune) AS p FROM communes) WHERE p <= 3""",
)
def top_per_department(spark, folder):
    rows = S.communes(spark, folder).select("code_departement", "code_commune", "population")
    return top_per_key(rows, ["code_departement"], [F.desc_nulls_last("population"), F.col("code_commune")], 3)
