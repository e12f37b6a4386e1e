"""Salary extraction from free text, in three phases, all inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.text import bind

# One rewrite per phase turns each match into a record "\1field\2field...\1", so a text is
# scanned once per phase whatever the number of groups.
_RECORD = "\u0001"
_FIELD = "\u0002"
_RESULT = "struct<low:double,high:double,currency:string>"


def _matches(text: Column, pattern: str, groups: int) -> Column:
    """All matches of a pattern, each as the array of its group texts ('' if a group is unused)."""
    record = _RECORD + _FIELD.join(f"${g}" for g in range(1, groups + 1)) + _RECORD
    pieces = F.split(F.regexp_replace(text, pattern, record), _RECORD)
    hits = F.filter(pieces, lambda piece, i: i % 2 == 1)
    return F.transform(hits, lambda hit: F.split(hit, _FIELD))


def _amount(digits: Column, thousands: Column) -> Column:
    value = F.replace(digits, F.lit(","), F.lit("")).try_cast("double")
    return F.when(thousands != "", value * 1000.0).otherwise(value)


def _currency(symbol: Column) -> Column:
    code = F.lit(None).cast("string")
    for sign, name in V.CURRENCY_SYMBOLS.items():
        code = F.when(symbol == sign, F.lit(name)).otherwise(code)
    return code


def _offer(a: Column, b: Column, currency: Column, tail: Column) -> Column:
    return F.struct(
        F.least(a, b).alias("low"),
        F.greatest(a, b).alias("high"),
        currency.alias("currency"),
        tail.alias("tail"),
    )


def _plausible(offer: Column) -> Column:
    return offer["low"].between(V.MIN_SALARY, V.MAX_SALARY) & offer["high"].between(V.MIN_SALARY, V.MAX_SALARY)


def _symbol_range(m: Column) -> Column:
    low, high = _amount(m[1], m[2]), _amount(m[3], m[4])
    inherits_k = (m[4] != "") & (m[2] == "") & (low < 1000)
    return _offer(F.when(inherits_k, low * 1000.0).otherwise(low), high, _currency(m[0]), m[5])


def _k_range(m: Column) -> Column:
    return _offer(_amount(m[0], m[3]), _amount(m[2], m[3]), F.nullif(F.upper(m[4]), F.lit("")), F.lit(""))


def _single(m: Column) -> Column:
    value = _amount(m[1], m[2])
    return _offer(value, value, _currency(m[0]), m[3])


def _first_offer(text: Column, pattern: str, groups: int, read) -> Column:
    offers = F.transform(_matches(text, pattern, groups), read)
    good = F.filter(offers, lambda o: _plausible(o) & ~o["tail"].rlike(V.HOURLY))
    first = F.get(F.transform(good, lambda o: F.struct(o["low"], o["high"], o["currency"])), F.lit(0))
    return F.when(text.rlike(pattern), first)


def extract_salary(text: Column) -> Column:
    """Text -> struct(low, high, currency) of the first plausible offer, or null.

    A symbol range is preferred to a ``120-150k`` range, that to a single symbol amount.
    Hourly rates and amounts outside the annual bounds do not count.
    """
    clash = text.contains(_RECORD) | text.contains(_FIELD)
    safe = F.when(clash, F.translate(text, _RECORD + _FIELD, "\u0003\u0003")).otherwise(text)

    def phases(t: Column) -> Column:
        # Most texts name no currency sign; looking for one is far cheaper than two patterns.
        signed = reduce(or_, [t.contains(sign) for sign in V.CURRENCY_SYMBOLS])
        return F.coalesce(
            F.when(signed, _first_offer(t, V.SALARY_SYMBOL_RANGE, 6, _symbol_range)),
            _first_offer(t, V.SALARY_K_RANGE, 5, _k_range),
            F.when(signed, _first_offer(t, V.SALARY_SINGLE, 4, _single)),
        ).cast(_RESULT)

    return bind(safe, phases)


def salary_mid(low: Column, high: Column) -> Column:
    return (low + high) / 2
