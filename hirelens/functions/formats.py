"""Display texts for money, salaries and timestamps (half-even rounding throughout)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _thousands(c: Column) -> Column:
    return F.concat(F.bround(c / 1000, 0).cast("decimal(38,0)").cast("string"), F.lit("k"))


def _with_currency(currency: Column, span: Column) -> Column:
    return F.trim(F.concat_ws(" ", F.coalesce(currency, F.lit("")), span))


def format_salary(low: Column, high: Column, currency: Column) -> Column:
    """``USD 120k-150k``, one figure if both ends agree, '' if unknown."""
    span = F.when(low == high, _thousands(low)).otherwise(F.concat_ws("-", _thousands(low), _thousands(high)))
    return F.when(low.isNull() | high.isNull(), F.lit("")).otherwise(_with_currency(currency, span))


def salary_text(low: Column, high: Column, currency: Column) -> Column:
    """``USD 120k–150k``, always a range, '' if unknown."""
    span = F.concat_ws("–", _thousands(low), _thousands(high))
    return F.when(low.isNull() | high.isNull(), F.lit("")).otherwise(_with_currency(currency, span))


def format_money(c: Column) -> Column:
    """``$137k`` with thousands separators, an em dash for null."""
    return F.coalesce(F.concat(F.lit("$"), F.format_number(c / 1000, 0), F.lit("k")), F.lit("—"))


def format_update(ts: Column) -> Column:
    """``05 Jan 2026, 14:03 UTC``, an em dash for null."""
    return F.coalesce(F.date_format(ts, "dd MMM yyyy, HH:mm 'UTC'"), F.lit("—"))
