"""Small text helpers shared by the classifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm(c: Column) -> Column:
    """The one normalisation every classifier applies: trim(lower(coalesce(x, '')))."""
    return F.trim(F.lower(F.coalesce(c, F.lit(""))))


def any_of(tokens: list[str]) -> str:
    """Unanchored alternation of literal tokens (dots escaped)."""
    return "(" + "|".join(t.replace(".", r"\.") for t in tokens) + ")"


def whole_of(tokens: list[str]) -> str:
    """Whole-string alternation of literal tokens."""
    return "^" + any_of(tokens) + "$"


def sql_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
