"""Column idioms shared by the place operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value once, so that an expression that uses it often stays small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def present(text: Column) -> Column:
    """Neither null nor blank."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a pattern; null where there is none or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def first_match(text: Column, patterns: list[str], group: int = 1) -> Column:
    """The first pattern that matches decides."""
    return F.coalesce(*[extract(text, p, group) for p in patterns])


def chain(cases: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """First condition that holds decides."""
    out = None
    for condition, value in cases:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)
