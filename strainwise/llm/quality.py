"""Quality rules with thresholds that each language and source sets for itself.

A document's measures are counted from its whole text.  Per (language, source) every measure is summed up in a sketch of
logarithmic bins: counts by bin, which merge by addition and give any quantile within ``ACCURACY`` of its value, the same on every run.
Small groups are judged by the merged sketch of their language, and small languages by that of the corpus.  Documents are then
joined with the fences of their group: the quartiles, moved outwards by some times the distance between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Fence:
    """A measure, as a fraction of two counts, its smallest spread, and whether low values are outliers too."""

    over: str
    under: str
    spread: float
    both: bool = False


FENCES = {
    "word_length": Fence("word_chars", "n_words", 0.5, both=True),
    "symbols": Fence("n_symbols", "n_words", 0.03),
    "duplicate_lines": Fence("n_dup_lines", "n_lines", 0.15),
    "repeats": Fence("n_repeat_words", "n_words", 0.15),
}
REACH = 3.0
GROUP_ROWS = 50


def counts_of(text: str | None) -> tuple[int, ...]:
    """The measures of one text, in the order of ``BASE``."""
    body = text or ""
    raw = body.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes: exactly the six white characters
    lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    first = dict(zip(reversed(windows), range(len(windows) - 1, -1, -1)))
    if len(first) < len(windows):
        twice = {w for i, w in enumerate(windows) if first[w] != i}
        covered = np.zeros(len(words) + 1, np.int64)
        at = np.fromiter((i for i, w in enumerate(windows) if w in twice), np.int64)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + 3, -1)
        repeated = int((np.cumsum(covered) > 0).sum())
    return (
        len(words),
        len(body) - (len(raw) - len(raw.translate(None, WHITE))),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
    )


def measure(df: DataFrame, text: str) -> DataFrame:
    """Add the counts of ``BASE`` as longs, and ``base_failed``: fewer than 50 words, or over half of them in repeated windows of three.

    Null and empty texts count as zero and fail.  Columns called like an output are replaced, all else stays.
    """
    names = ", ".join(f"{name}: long" for name in BASE)

    @F.arrow_udf(f"struct<{names}>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.array([counts_of(t.as_py()) for t in batch], np.int64).reshape(-1, len(BASE))
            yield pa.StructArray.from_arrays([pa.array(column) for column in values.T], BASE)

    held = df.withColumn("__counts", count(F.col(f"`{text}`")))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (*BASE, "base_failed")]
    counted = held.select(*kept, *[F.col("__counts")[name].alias(name) for name in BASE])
    return counted.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def _measures() -> dict[str, Column]:
    return {
        name: F.when(F.col(f.under) > 0, F.col(f.over) / F.col(f.under)).otherwise(F.lit(0.0)) for name, f in FENCES.items()
    }


def bin_of(value: Column) -> Column:
    """Number of the bin of a value; zero has a bin below all others."""
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(float(np.log(GAMMA))))).otherwise(F.lit(-100_000)).cast("int")


def value_of(number: Column) -> Column:
    return F.when(number == -100_000, F.lit(0.0)).otherwise(2 * F.pow(F.lit(GAMMA), number) / (GAMMA + 1))


def sketches(measured: DataFrame, groups: list[str]) -> DataFrame:
    """(level, groups..., measure, bin, n): sketches by all groups (level 0), by the first ones only, ..., and of everything.

    Only documents that pass the base rules count.  The merged levels are sums of the finest sketches.
    """
    rows = measured.filter(~F.col("base_failed")).select(
        *groups,
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("measure"), bin_of(value).alias("bin")) for name, value in _measures().items()
        ])).alias("m"),
    )
    finest = rows.groupBy(*groups, "m.measure", "m.bin").agg(F.count("*").alias("n"))
    levels = []
    for level in range(len(groups) + 1):
        held = groups[: len(groups) - level]
        blank = [F.lit(None).cast("string").alias(g) for g in groups[len(held):]]
        levels.append(F.struct(F.lit(level).alias("level"), *[F.col(g).cast("string").alias(g) for g in held], *blank))
    return (
        finest.withColumn("at", F.explode(F.array(*levels)))
        .groupBy(F.col("at.level").alias("level"), *[F.col(f"at.{g}").alias(g) for g in groups], "measure", "bin")
        .agg(F.sum("n").alias("n"))
    )


def fences(measured: DataFrame, groups: list[str]) -> DataFrame:
    """One row per group of documents: the groups, then ``<measure>_low`` and ``<measure>_high``.

    Taken from the finest level of sketches that has ``GROUP_ROWS`` documents; the corpus as a whole is taken whatever its size.
    Groups whose documents all fail the base rules are judged like small ones.
    """
    unit = ["level", *groups, "measure"]
    whole, upto = Window.partitionBy(*unit), Window.partitionBy(*unit).orderBy("bin")
    counted = (
        sketches(measured, groups).withColumn("total", F.sum("n").over(whole)).withColumn("below", F.sum("n").over(upto))
    )

    def quartile(q: float) -> Column:
        return value_of(F.min(F.when(F.col("below") >= q * F.col("total"), F.col("bin"))))

    quartiles = counted.groupBy(*unit).agg(quartile(0.25).alias("q1"), quartile(0.75).alias("q3"), F.max("total").alias("total"))
    table = F.lit(None)
    for name, fence in FENCES.items():
        spread = REACH * F.greatest(F.col("q3") - F.col("q1"), F.lit(fence.spread))
        low = F.col("q1") - spread if fence.both else F.lit(float("-inf"))
        table = F.when(F.col("measure") == name, F.struct(low.alias("low"), (F.col("q3") + spread).alias("high"))).otherwise(table)
    at_level = quartiles.withColumn("fence", table).groupBy("level", *groups).agg(
        F.max("total").alias("total"),
        *[
            F.max(F.when(F.col("measure") == name, F.col(f"fence.{side}"))).alias(f"{name}_{side}")
            for name in FENCES for side in ("low", "high")
        ],
    )
    columns = [f"{name}_{side}" for name in FENCES for side in ("low", "high")]
    present = measured.select(*[F.col(g).cast("string").alias(g) for g in groups]).distinct()
    wanted = present.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(len(groups)))))
    same = wanted["level"] == at_level["level"]
    for i, g in enumerate(groups):
        same = same & F.when(wanted["level"] < len(groups) - i, wanted[g]).eqNullSafe(at_level[g])
    usable = wanted.join(at_level, same).filter((F.col("total") >= GROUP_ROWS) | (wanted["level"] == len(groups)))
    return usable.groupBy(*[wanted[g] for g in groups]).agg(
        F.min_by(F.struct(*columns), wanted["level"]).alias("__fence")
    ).select(*groups, *[F.col("__fence")[c].alias(c) for c in columns])


def judge(measured: DataFrame, limits: DataFrame, groups: list[str]) -> DataFrame:
    """Add ``kept``: false where the base rules fail or a measure is outside its group's fences.

    Without any document that passes the base rules there are no fences, and nothing is kept.  ``measured`` keeps its columns.
    """
    named = limits.select(*[F.col(g).alias(f"__{g}") for g in groups], *[c for c in limits.columns if c not in groups])
    match = F.lit(True)
    for g in groups:
        match = match & measured[g].cast("string").eqNullSafe(named[f"__{g}"])
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & value.between(F.col(f"{name}_low"), F.col(f"{name}_high"))
    return measured.join(named, match, "left").select(
        *[measured[c] for c in measured.columns],
        F.coalesce(~F.col("base_failed") & inside, F.lit(False)).alias("kept"),
    )
