"""Ordered banding and risk rules.

``band`` builds one ``CASE WHEN`` from (predicate, label) pairs: the first
true predicate wins, and a NULL predicate falls through to the next rule and
finally to the default, exactly like SQL CASE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnOrName, bool_default_false, col


def band(rules: Sequence[tuple[Column, str]], default: str | None) -> Column:
    expr = None
    for pred, label in rules:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def account_age_band(days: ColumnOrName) -> Column:
    d = col(days)
    return band([(d < 180, "New"), (d < 365, "LESS THAN 1 YEAR"), (d < 1095, "1_TO_3_YEARS")],
                "MORE_THAN_3_YEARS")


def balance_band(balance: ColumnOrName) -> Column:
    b = col(balance)
    return band([(b < 0, "NEGATIVE"), (b == 0, "ZERO"), (b < 1000, "LOW"), (b < 10000, "MEDIUM")],
                "HIGH")


def credit_health_flag(balance: ColumnOrName, limit: ColumnOrName) -> Column:
    """Utilisation rounded to a whole number (0 or 1 in practice) against 0.8 / 0.5 / 0.

    Rounding to 0 digits first makes the middle rule unreachable: a ratio of
    0.5 or more rounds to >= 1 (HIGH), below 0.5 rounds to 0 (LOW).
    """
    lim = col(limit)
    ratio = F.round(F.try_divide(F.abs(col(balance)), lim), 0)
    has_limit = lim > 0
    return band([(has_limit & (ratio > 0.8), "HIGH UTILIZATION"),
                 (has_limit & (ratio > 0.5), "MEDIUM UTILIZATION"),
                 (has_limit & (ratio >= 0), "LOW UTILIZATION")],
                "NOT APPLICABLE")


def credit_score_band(score: ColumnOrName) -> Column:
    s = col(score)
    return band([(s >= 750, "EXCELLENT"), (s >= 700, "GOOD"), (s >= 650, "FAIR")], "POOR")


def debt_to_income_band(dti: ColumnOrName) -> Column:
    d = col(dti)
    return band([(d < 0.3, "LOW"), ((d >= 0.3) & (d < 0.5), "MEDIUM"), (d >= 0.5, "HIGH")],
                "NOT APPLICABLE")


def loan_size_band(applied: ColumnOrName) -> Column:
    a = col(applied)
    return band([(a < 10000, "SMALL"), ((a >= 10000) & (a < 100000), "MEDIUM"), (a >= 100000, "LARGE")],
                "UNKNOWN")


def transaction_size_band(abs_amount: ColumnOrName) -> Column:
    a = col(abs_amount)
    return band([(a < 10, "MICRO"), ((a >= 10) & (a < 100), "SMALL"), ((a >= 100) & (a < 1000), "MEDIUM")],
                "LARGE")


def fraud_risk_band(hour: ColumnOrName) -> Column:
    h = col(hour)
    return band([(h.between(0, 5), "LOW RISK"), (h.between(6, 11), "MEDIUM RISK"),
                 (h.between(12, 17), "HIGH RISK")],
                "VERY HIGH RISK")


def is_high_risk_loan(score: ColumnOrName, dti: ColumnOrName) -> Column:
    return bool_default_false((col(score) < 650) & (col(dti) > 0.4))


def is_category(category: ColumnOrName, value: str) -> Column:
    """Exact match on the (already upper-cased) merchant category."""
    return bool_default_false(col(category) == F.lit(value))


def is_fraud(score: ColumnOrName) -> Column:
    return bool_default_false(col(score) > 70)


def is_overseas(matched_city: ColumnOrName) -> Column:
    """True when the city lookup found no row (including a NULL city)."""
    return col(matched_city).isNull()


def transaction_risk_level(te_is_fraud: ColumnOrName, te_is_overseas: ColumnOrName,
                           te_is_gambling: ColumnOrName, fraud_score: ColumnOrName) -> Column:
    fraud, overseas, gambling, score = (col(te_is_fraud), col(te_is_overseas),
                                        col(te_is_gambling), col(fraud_score))
    return band([(fraud & overseas, "HIGH"),
                 (fraud, "HIGH"),
                 (score > 70, "HIGH"),
                 (gambling & (score > 30), "MEDIUM"),
                 (overseas, "MEDIUM"),
                 (gambling, "LOW_RISK")],
                "NORMAL")
