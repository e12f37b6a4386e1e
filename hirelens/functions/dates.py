"""Date parsing without format exceptions: recognise the shape, then one safe cast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V
from hirelens.functions.text import bind, normalize_text

_NAMES = "|".join(m if len(m) == 3 else f"{m[:3]}(?:{m[3:]})?" for m in V.MONTHS)
_STARTS = " ".join(m[:3] for m in V.MONTHS)
# Any one character may part date and time; hours, minutes, seconds and offsets stay within a day.
_CLOCK = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?)?"
_OFFSET = r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.,]\d+)?)?)?)?"
_ISO = rf"(?s)^\d{{4}}-\d{{2}}-\d{{2}}(.{_CLOCK}{_OFFSET})?$"
_YEAR_FIRST = r"^\d{4}-\d{1,2}-\d{1,2}$"
_MONTH_FIRST = rf"(?i)^({_NAMES}) (\d{{1,2}}), (\d{{4}})$"
_DAY_FIRST = rf"(?i)^(\d{{1,2}}) ({_NAMES}) (\d{{4}})$"
_SLASHED = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"


def _month_number(name: Column) -> Column:
    at = F.position(F.lower(F.left(name, F.lit(3))), F.lit(_STARTS))
    return ((at + 3) / 4).cast("int").cast("string")


def parse_date_text(text: Column) -> Column:
    """Normalised text -> date, null if no format fits.

    ISO dates keep the written day whatever their offset. Slashed dates are read
    day first, then month first.
    """

    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def ymd(year: Column, month: Column, day: Column) -> Column:
        return F.concat_ws("-", year, month, day).try_cast("date")

    slashed = [part(_SLASHED, g) for g in (1, 2, 3)]
    return (
        F.when(text.rlike(_ISO), F.left(text, F.lit(10)).try_cast("date"))
        .when(text.rlike(_YEAR_FIRST), text.try_cast("date"))
        .when(
            text.rlike(_MONTH_FIRST),
            ymd(part(_MONTH_FIRST, 3), _month_number(part(_MONTH_FIRST, 1)), part(_MONTH_FIRST, 2)),
        )
        .when(
            text.rlike(_DAY_FIRST),
            ymd(part(_DAY_FIRST, 3), _month_number(part(_DAY_FIRST, 2)), part(_DAY_FIRST, 1)),
        )
        .when(
            text.rlike(_SLASHED),
            F.coalesce(
                ymd(slashed[2], slashed[1], slashed[0]),
                ymd(slashed[2], slashed[0], slashed[1]),
            ),
        )
    )


def parse_date(c: Column) -> Column:
    return bind(normalize_text(c), parse_date_text)
