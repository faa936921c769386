"""Money columns: decimal casts, value bands, cent-exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salespark.schemas import MONEY_SUM, MONEY_TOTAL, MONEY_UNIT

# Value-band thresholds (total < 50 low, < 200 medium, else high).
BAND_LOW_BELOW = 50
BAND_MEDIUM_BELOW = 200
BANDS = ("low", "medium", "high")
# The star schema's CHECK lists a different middle name; kept for reporting.
SCHEMA_BANDS = ("low", "mid", "high")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_band(total: Column | str) -> Column:
    """Band of a sale total; an absent total counts as 0 (-> low).

    This is the event-path rule; ``value_band_sql`` is the SQL-job rule where a
    NULL total falls through to the ELSE branch."""
    t = F.coalesce(_c(total), F.lit(0))
    return (F.when(t < BAND_LOW_BELOW, "low")
             .when(t < BAND_MEDIUM_BELOW, "medium")
             .otherwise("high"))


def value_band_sql(total: Column | str) -> Column:
    t = _c(total)
    return (F.when(t < BAND_LOW_BELOW, "low")
             .when(t < BAND_MEDIUM_BELOW, "medium")
             .otherwise("high"))


def unit_money(c: Column | str) -> Column:
    return _c(c).cast(MONEY_UNIT)


def total_money(c: Column | str) -> Column:
    return _c(c).cast(MONEY_TOTAL)


def mean_cents(total: Column | str, n: Column | str) -> Column:
    """``total / n`` rounded half-up to cents; 0 when n = 0.

    Decimal division, so the result does not depend on summation order (a
    double accumulator would)."""
    total, n = _c(total), _c(n)
    return (F.when(n == 0, F.lit(0))
             .otherwise(F.round(total / n, 2))).cast(MONEY_SUM)
