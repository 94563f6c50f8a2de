"""Concentration intervals such as ``(0.5,1]`` held as canonical text plus numeric bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A decimal number as laboratories type it: comma or point, leading digit optional.
NUMBER = r"(\d+[.,]?\d*|[.,]\d+)"
_TYPED_INTERVAL = rf"^(\(|\[){NUMBER},{NUMBER}(\)|\])"
_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_SIGNED = rf"^(≤|≥|[<>]=?){NUMBER}"
_PAIR = rf"^{NUMBER}(?:or|/|-){NUMBER}"
_BOUNDS = r"[\(|\[](.*),(.*)[\]\)]"


def point_decimal(text: Column) -> Column:
    """Use the point as decimal separator."""
    return F.replace(text, F.lit(","), F.lit("."))


def decimal_text(text: Column) -> Column:
    """Shortest decimal text with at least one fraction digit: ``5`` -> ``5.0``, ``.50`` -> ``0.5``."""
    t = F.trim(point_decimal(text))
    t = F.regexp_replace(t, r"(?<![0-9])\.", "0.")
    t = F.when(F.instr(t, ".") > 0, F.regexp_replace(t, r"0+$", "")).otherwise(F.concat(t, F.lit(".")))
    t = F.regexp_replace(t, r"\.$", ".0")
    return F.regexp_replace(F.regexp_replace(t, r"^\+", ""), r"^(-?)0+(?=\d)", "$1")


def _number_text(text: Column) -> Column:
    t = F.trim(point_decimal(text))
    return F.when(t.rlike("[eE]"), t.try_cast("double").cast("string")).otherwise(decimal_text(t))


def interval(low: Column, high: Column, opening: str = "(", closing: str = "]") -> Column:
    return F.concat(F.lit(opening), low, F.lit(","), high, F.lit(closing))


def canonical_interval(value: Column, lower: Column | None = None, halve_points: bool = False) -> Column:
    """Bring a laboratory MIC entry into interval form; the first form that fits wins.

    1. already an interval (decimal commas allowed), 2. known next lower tested
    concentration ``lower`` -> ``(lower,value]``, 3. plain number ``v`` -> ``[v,v]``
    (or ``(v/2,v]`` with ``halve_points``), 4. a comparison sign, 5. two numbers
    joined by ``-``, ``/`` or ``or``.  Anything else is kept as typed.
    """
    packed = F.replace(value, F.lit(" "), F.lit(""))
    typed = F.concat(
        F.regexp_extract(packed, _TYPED_INTERVAL, 1),
        point_decimal(F.regexp_extract(packed, _TYPED_INTERVAL, 2)),
        F.lit(","),
        point_decimal(F.regexp_extract(packed, _TYPED_INTERVAL, 3)),
        F.regexp_extract(packed, _TYPED_INTERVAL, 4),
    )
    point = F.trim(point_decimal(value))
    exact = _number_text(value)
    if halve_points:
        halved = (point.try_cast("double") / 2).cast("string")
        plain = interval(halved, exact)
    else:
        plain = interval(exact, exact, "[", "]")
    sign = F.regexp_extract(packed, _SIGNED, 1)
    limit = decimal_text(F.regexp_extract(packed, _SIGNED, 2))
    first, second = F.regexp_extract(value, _PAIR, 1), F.regexp_extract(value, _PAIR, 2)

    chain = F.when(packed.rlike(_TYPED_INTERVAL), typed)
    if lower is not None:
        chain = chain.when(lower.isNotNull(), interval(lower.cast("string"), value))
    return (
        chain.when(point.rlike(_PLAIN_NUMBER), plain)
        .when(sign.isin("<=", "≤"), interval(F.lit("0"), limit))
        .when(sign == "<", interval(F.lit("0"), limit, closing=")"))
        .when(sign.isin(">=", "≥"), interval(limit, F.lit(""), "[", ")"))
        .when(sign == ">", interval(limit, F.lit(""), "(", ")"))
        .when(value.rlike(_PAIR), interval(point_decimal(first), point_decimal(second)))
        .otherwise(value)
    )


def lower_bound(text: Column) -> Column:
    """Lower end as double; NULL when open."""
    return F.regexp_extract(text, _BOUNDS, 1).try_cast("double")


def upper_bound(text: Column) -> Column:
    """Upper end as double; NULL when open."""
    return F.regexp_extract(text, _BOUNDS, 2).try_cast("double")


def interval_struct(text: Column) -> Column:
    """Interval as ``struct<lo, hi, lo_inc, hi_inc>``."""
    return F.struct(
        lower_bound(text).alias("lo"),
        upper_bound(text).alias("hi"),
        text.startswith("[").alias("lo_inc"),
        text.endswith("]").alias("hi_inc"),
    )
