"""Deterministic text aggregation and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def set_text(column: Column, separator: str) -> Column:
    """Aggregate: distinct values in sorted order, joined."""
    return F.concat_ws(separator, F.sort_array(F.collect_set(column.cast("string"))))


def ordered_text(order: Column, column: Column, separator: str) -> Column:
    """Aggregate: every value, ordered by ``order`` and then by itself, joined."""
    pairs = F.sort_array(F.collect_list(F.struct(order.alias("o"), column.alias("v"))))
    return F.concat_ws(separator, F.transform(pairs, lambda p: p["v"]))


def blank_to_null(column: Column) -> Column:
    return F.when(F.trim(column) != "", column)


def first_match(rules: list[tuple[Column, Column]], default: Column | None = None) -> Column:
    """CASE from an ordered rule list; the first condition that holds decides."""
    (condition, value), *rest = rules
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain if default is None else chain.otherwise(default)


def priority(column: Column, names: list[str], otherwise: int | None = None) -> Column:
    """Rank of a value in an ordered name list, starting at 1."""
    chain = first_match([(column == name, F.lit(position)) for position, name in enumerate(names, 1)])
    return chain if otherwise is None else chain.otherwise(F.lit(otherwise))
