"""Loan, rent and tax formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle import params as P


def _column(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def annuity_factor(rate_pct, years) -> Column:
    """Monthly instalment per euro borrowed."""
    monthly = _column(rate_pct) / 1200
    months = _column(years) * 12
    spread = monthly / (1 - F.pow(1 + monthly, -months))
    return F.when(monthly == 0, F.lit(1.0) / months).otherwise(spread)


def annuity(principal, rate_pct, years) -> Column:
    return _column(principal) * annuity_factor(rate_pct, years)


def remaining_debt(principal, rate_pct, years, months_paid) -> Column:
    """Closed form of the monthly loop, never below zero."""
    p, t = _column(principal), _column(rate_pct) / 1200
    n, m = _column(years) * 12, F.least(_column(months_paid), _column(years) * 12)
    grown = F.pow(1 + t, m)
    left = p * grown - annuity(p, rate_pct, years) * F.try_divide(grown - 1, t)
    return F.greatest(F.when(t == 0, p * (1 - m / n)).otherwise(left), F.lit(0.0))


def insurance_rate(age) -> Column:
    out = F.lit(P.INSURANCE_TOP)
    for bound, rate in reversed(P.INSURANCE_BRACKETS):
        out = F.when(_column(age) < bound, F.lit(rate)).otherwise(out)
    return out


def gross_yield(price_m2) -> Column:
    out = F.lit(P.YIELD_TOP)
    for bound, rate in reversed(P.YIELD_BRACKETS):
        out = F.when(_column(price_m2) < bound, F.lit(rate)).otherwise(out)
    return out


def estimated_rent(price_m2, surface, observed_m2, furnished: bool) -> Column:
    """Monthly rent: observed rent per square metre if positive, else by yield."""
    observed = _column(observed_m2)
    by_yield = _column(price_m2) * _column(surface) * gross_yield(price_m2) / 1200
    bare = F.when(observed > 0, observed * _column(surface)).otherwise(by_yield)
    return bare * P.FURNISHED_FACTOR if furnished else bare


def market_rate(years) -> Column:
    out = F.lit(P.MARKET_RATE_DEFAULT)
    for term, rate in P.MARKET_RATES.items():
        out = F.when(_column(years) == term, F.lit(rate)).otherwise(out)
    return out


def yearly_tax(regime: str, rent, charges, interest, amortisation, tax_share) -> Column:
    """Tax on a year of rent under one of the four regimes."""
    rent, charges, interest = _column(rent), _column(charges), _column(interest)
    if regime not in P.REGIMES:
        raise ValueError(f"unknown tax regime: {regime}")
    if regime == P.REGIMES[0]:
        base = F.greatest(rent - charges - interest - _column(amortisation), F.lit(0.0))
    elif regime == P.REGIMES[1]:
        base = rent * 0.50
    elif regime == P.REGIMES[2]:
        base = F.greatest(rent - charges - interest, F.lit(0.0))
    else:
        base = rent * 0.70
    return base * _column(tax_share)
