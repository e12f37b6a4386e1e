"""Remote and seniority flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import fixed_values as V

# The letters that offers and refusals of remote work begin with, looked at before the costly Unicode word border.
_OFFER = rf"(?=[rRwWfFdD]){V.REMOTE_POSITIVE}"
_REFUSAL = rf"(?=[nNwWrRoO])(?:{V.REMOTE_NEGATIVE})"


def detect_remote(text: Column) -> Column:
    """True if remote work is offered once explicit refusals are taken out."""
    kept = F.regexp_replace(text, _REFUSAL, " ")
    # Taking refusals out never creates an offer, so texts without one skip the rewrite.
    return F.coalesce(text.rlike(_OFFER) & kept.rlike(_OFFER), F.lit(False))


def remote_scope(title: Column, location: Column, description: Column) -> Column:
    """Header area on which the remote flag is judged."""
    empty = F.lit("")
    return F.concat_ws(
        "\n",
        F.coalesce(title, empty),
        F.coalesce(location, empty),
        F.left(F.coalesce(description, empty), F.lit(V.REMOTE_SCOPE_CHARS)),
    )


def detect_seniority(title: Column) -> Column:
    """First matching rule, null if none does."""
    (label, pattern), *rest = V.SENIORITY_RULES
    level = F.when(title.rlike(pattern), F.lit(label))
    for label, pattern in rest:
        level = level.when(title.rlike(pattern), F.lit(label))
    return level
