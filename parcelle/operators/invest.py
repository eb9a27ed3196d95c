"""Rental-investment metrics for every commune, loan capacity, yearly projection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle import params as P
from parcelle.functions import finance as fin
from parcelle.functions.scores import clip, steady_round
from parcelle.operators.columns import computed_once, ensure_columns


@dataclass(frozen=True)
class Project:
    """One investor's assumptions; the defaults are those of a first purchase."""

    surface: float = 45.0
    years: int = 20
    age: int = 30
    down_payment: float = 15_000.0
    furnished: bool = True
    notary_pct: float = 7.5
    agency_pct: float = 0.0
    brokerage: float = 1_500.0
    works: float = 0.0
    furniture: float = 5_000.0
    condo_charges: float = 1_200.0
    fixed_property_tax: float = 0.0
    management_pct: float = 0.0
    upkeep: float = 500.0
    vacancy_pct: float = 5.0
    rent_adjust_pct: float = 0.0
    regime: str = P.REGIMES[0]
    marginal_tax_pct: float = 30.0
    rate_pct: float | None = None
    insurance_pct: float | None = None

    @property
    def rate(self) -> float:
        return P.MARKET_RATES.get(self.years, P.MARKET_RATE_DEFAULT) if self.rate_pct is None else self.rate_pct

    @property
    def insurance(self) -> float:
        if self.insurance_pct is not None:
            return self.insurance_pct
        return next((r for bound, r in P.INSURANCE_BRACKETS if self.age < bound), P.INSURANCE_TOP)

    @property
    def tax_share(self) -> float:
        return (self.marginal_tax_pct + P.SOCIAL_LEVIES_PCT) / 100

    @property
    def fee_share(self) -> float:
        return (self.notary_pct + self.agency_pct) / 100

    @property
    def fixed_costs(self) -> float:
        return self.brokerage + self.works + (self.furniture if self.furnished else 0.0)


def _rent_column(surface: float) -> str:
    if surface <= 50:
        return "loyer_m2_app12"
    return "loyer_m2_app3" if surface >= 65 else "loyer_m2_app"


def property_tax(df: DataFrame, project: Project) -> Column:
    """Rental value x surface x rate; a flat amount if asked for or nothing is known."""
    if project.fixed_property_tax:
        return F.lit(float(project.fixed_property_tax))
    if "taux_tfb_dept" not in df.columns:
        return F.lit(700.0)
    by_rent = F.coalesce(F.col("loyer_m2_app"), F.col("avg_price_m2") * 0.004) * 0.5
    value = F.coalesce(F.col("vl_m2_commune"), by_rent) if "vl_m2_commune" in df.columns else by_rent
    rate = F.coalesce(F.col("taux_tfb_dept"), F.lit(P.PROPERTY_TAX_DEFAULT)) / 100
    known = df.where(F.col("taux_tfb_dept").isNotNull()).select("taux_tfb_dept").limit(1)
    any_rate = known.agg(F.count("taux_tfb_dept") > 0).scalar()
    return F.when(any_rate, steady_round(value * project.surface * 12 * rate, 0)).otherwise(700.0)


def rental_metrics(communes: DataFrame, project: Project = Project()) -> DataFrame:
    """Rent, charges, loan, tax, cash-flow and yields, before and after tax."""
    p = project
    none = F.lit(None).cast("double")
    df = ensure_columns(
        communes, {"loyer_m2_app": none, "loyer_m2_app12": none, "loyer_m2_app3": none}
    )
    price = F.col("avg_price_m2")
    df = df.withColumns(
        {
            "prix_bien_possible": price * p.surface,
            "loyer_theorique": fin.estimated_rent(price, p.surface, F.col(_rent_column(p.surface)), p.furnished),
            "loyer_source": F.when(F.col("loyer_m2_app") > 0, "ANIL 2024").otherwise("Estimation"),
            "taxe_fonciere_estimee": property_tax(df, p),
            "rendement_brut": fin.gross_yield(price),
        }
    )
    df = df.withColumn("loyer_estime", clip(F.col("loyer_theorique") * (1 + p.rent_adjust_pct / 100), 0))
    df = df.withColumn("loyer_encaisse", F.col("loyer_estime") * (1 - p.vacancy_pct / 100))
    df = df.withColumn("frais_gestion", F.col("loyer_encaisse") * (p.management_pct / 100 * 12))
    df = df.withColumns(
        {
            "charges_tot_annuelles": F.lit(p.condo_charges + p.upkeep)
            + F.col("taxe_fonciere_estimee") + F.col("frais_gestion"),
            "frais_notaire": F.col("prix_bien_possible") * (p.notary_pct / 100),
            "cout_acquisition_total": F.col("prix_bien_possible") * (1 + p.fee_share) + p.fixed_costs,
        }
    )
    df = df.withColumn("montant_emprunte", clip(F.col("cout_acquisition_total") - p.down_payment, 0))
    df = df.withColumns(
        {
            "mensualite_commune": F.col("montant_emprunte")
            * (fin.annuity_factor(p.rate, p.years) + p.insurance / 1200),
            "interets_annuels": F.col("montant_emprunte") * (p.rate / 100),
        }
    )
    rent, charges = F.col("loyer_encaisse") * 12, F.col("charges_tot_annuelles")
    furniture = (p.furniture if p.furnished else 0.0) * P.FURNITURE_AMORTISATION
    df = df.withColumn(
        "impot_annuel",
        fin.yearly_tax(
            p.regime, rent, charges, F.col("interets_annuels"),
            F.col("prix_bien_possible") * P.PROPERTY_AMORTISATION + furniture, p.tax_share,
        ),
    )
    cost = F.greatest(F.col("cout_acquisition_total"), F.lit(1.0))
    df = df.withColumns(
        {
            "cashflow_mensuel": rent / 12 - F.col("mensualite_commune") - charges / 12,
            "rendement_net": clip((rent - charges) / cost * 100, 0),
            "rendement_net_fiscal": clip((rent - charges - F.col("impot_annuel")) / cost * 100, 0),
        }
    )
    return df.withColumn("cashflow_net_fiscal", F.col("cashflow_mensuel") - F.col("impot_annuel") / 12)


def vacancy_risk(df: DataFrame) -> DataFrame:
    """Points on population, rent data and sales; level, label, rate, months, detail."""
    people = F.coalesce(F.col("population"), F.lit(0))
    sales = F.coalesce(F.col("transaction_count"), F.lit(0))
    no_rent = F.coalesce(F.col("loyer_m2_app"), F.lit(0.0)) == 0
    points = (
        F.when(people < 500, 3).when(people < 2_000, 2).when(people < 10_000, 1).otherwise(0)
        + F.when(no_rent, 2).otherwise(0)
        + F.when(sales < 3, 2).when(sales < 10, 1).otherwise(0)
    )
    level = F.when(points >= 6, 3).when(points >= 4, 2).when(points >= 2, 1).otherwise(0)

    def pick(position: int) -> Column:
        out = F.lit(P.VACANCY_LEVELS[-1][position])
        for row in reversed(P.VACANCY_LEVELS[:-1]):
            out = F.when(F.col("risque_vacance") <= row[0], F.lit(row[position])).otherwise(out)
        return out

    detail = F.concat_ws(
        " · ",
        F.when(people < 500, F.concat(F.lit("Population : "), people.cast("bigint").cast("string"), F.lit(" hab."))),
        F.when(no_rent, F.lit("Aucune donnée de loyer ANIL")),
        F.when(sales < 10, F.concat(F.lit("Seulement "), sales.cast("bigint").cast("string"), F.lit(" ventes DVF/an"))),
    )
    return (
        df.withColumn("risque_vacance", level)
        .withColumns(
            {
                "vacance_label": pick(1),
                "taux_vacance": pick(2),
                "detail_vacance": F.when(detail == "", "Indicateurs favorables").otherwise(detail),
            }
        )
        .withColumn("mois_vacance", steady_round(F.col("taux_vacance") * 12, 1))
    )


def borrow_capacity(
    profiles: DataFrame,
    max_debt_pct: float = 35.0,
    fee_share: float = 0.075,
    fixed_costs: float = 6_500.0,
) -> DataFrame:
    """Loan and top price per borrower. Columns read: salaire_net, autres_revenus,
    mensualites_existantes, apport, age, duree."""
    df = profiles.withColumns(
        {
            "taux": fin.market_rate(F.col("duree")),
            "taux_assurance": fin.insurance_rate(F.col("age")),
            "mensualite_max": F.greatest(
                (F.col("salaire_net") + F.col("autres_revenus")) * max_debt_pct / 100
                - F.col("mensualites_existantes"),
                F.lit(0.0),
            ),
        }
    )
    factor = fin.annuity_factor(F.col("taux"), F.col("duree")) + F.col("taux_assurance") / 1200
    df = df.withColumn("capacite_emprunt", F.col("mensualite_max") / factor)
    df = df.withColumn("budget_total_projet", F.col("capacite_emprunt") + F.col("apport"))
    return df.withColumns(
        {
            "prix_max_bien": F.greatest(
                (F.col("budget_total_projet") - fixed_costs) / (1 + fee_share), F.lit(0.0)
            ),
            "mensualite_assurance": F.col("capacite_emprunt") * F.col("taux_assurance") / 1200,
            "mensualite_totale": F.col("capacite_emprunt") * factor,
        }
    )


def market_labels(df: DataFrame) -> DataFrame:
    """Rent confidence, rental-market activity and growth beyond 20 % masked."""
    ads = F.col("nb_annonces_app")
    known = F.col("loyer_m2_app") > 0
    growth = F.col("annual_price_growth")
    return df.withColumns(
        {
            "confiance_loyer": F.when(known & (ads >= 5), "✓").when(known, "~").otherwise("*"),
            "marche_locatif": F.when(ads >= 30, F.concat(ads.cast("int").cast("string"), F.lit(" annonces 🔥")))
            .when(ads >= 5, F.concat(ads.cast("int").cast("string"), F.lit(" annonces")))
            .when(ads > 0, F.concat(ads.cast("int").cast("string"), F.lit(" annonce(s) — loyer estimé")))
            .when(known, "< 5 annonces — loyer estimé")
            .otherwise("Pas de données ANIL — loyer calculé"),
            "evolution_affichee": F.when(F.abs(growth) <= 0.20, growth),
        }
    )


def project(
    df: DataFrame,
    assumptions: Project = Project(),
    scenarios: Mapping[str, tuple[float, float, float]] = P.SCENARIOS,
    horizon: int = 20,
    appreciation_pct: float = 1.0,
    key: str = "code_commune",
) -> DataFrame:
    """One property per commune, scenario and year.

    Reads the columns of ``rental_metrics`` and ``taux_vacance``. The monthly loan loop is replaced by its closed form. The
    years of a scenario are built as an array inside their row, the running cash-flow along it, and unfolded last, so
    nothing is shuffled or sorted.
    """
    p = assumptions
    cases = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario"), F.lit(r).alias("rent_pct"),
                F.lit(c).alias("charge_pct"), F.lit(g).alias("gain_pct"),
            )
            for name, (r, c, g) in scenarios.items()
        ]
    )
    loan, value = F.col("montant_emprunte"), F.col("prix_bien_possible")
    base = df.select(
        key, "prix_bien_possible", "montant_emprunte", "mensualite_commune", "loyer_estime",
        "charges_tot_annuelles", "taux_vacance", F.inline(cases),
    )
    furniture = (p.furniture if p.furnished else 0.0) * P.FURNITURE_AMORTISATION

    def year_row(year: Column) -> Column:
        before = year - 1
        rent = F.col("loyer_estime") * 12 * F.pow(1 + F.col("rent_pct") / 100, before)
        received = rent * (1 - F.col("taux_vacance"))
        charges = F.col("charges_tot_annuelles") * F.pow(1 + F.col("charge_pct") / 100, before)
        debt = fin.remaining_debt(loan, p.rate, p.years, year * 12)
        credit = F.when(year < p.years, F.col("mensualite_commune") * 12).otherwise(0.0)
        tax = fin.yearly_tax(
            p.regime, rent, charges, debt * (p.rate / 100), value * P.PROPERTY_AMORTISATION + furniture, p.tax_share
        )
        return F.struct(
            year.alias("annee"), received.alias("loyer_annuel"), charges.alias("charges"), credit.alias("credit"), tax.alias("impot"),
            (received - credit - charges - tax).alias("cashflow"), debt.alias("dette"),
            (value * F.pow(F.lit(1 + appreciation_pct / 100), year)).alias("valeur"),
        )

    years = computed_once(base, {"_years": F.transform(F.sequence(F.lit(1), F.lit(horizon)), year_row)})

    def added(totals: Column, row: Column) -> Column:
        # like a running sum: missing flows are passed over
        last = F.get(totals, F.size(totals) - 1)
        return F.concat(totals, F.array(F.coalesce(last + row["cashflow"], last, row["cashflow"])))

    totals = F.aggregate("_years", F.array().cast("array<double>"), added)
    with_total = F.zip_with("_years", totals, lambda row, total: F.struct(row.alias("y"), total.alias("cashflow_cumule")))
    unfolded = years.select(key, "scenario", "gain_pct", "prix_bien_possible", F.inline(with_total)).select(
        key, "scenario", "gain_pct", "prix_bien_possible", "y.*", "cashflow_cumule"
    )
    gain_tax = F.greatest(F.col("valeur") - value, F.lit(0.0)) * F.col("gain_pct") / 100
    return unfolded.select(
        key, "scenario", "annee", "loyer_annuel", "charges", "credit", "impot", "cashflow",
        "cashflow_cumule", "dette", "valeur",
        (F.col("valeur") - F.col("dette") + F.col("cashflow_cumule")).alias("patrimoine_net"),
        (F.col("valeur") - F.col("dette") - gain_tax).alias("net_revente"),
    )
