"""Generic table operators that the domain operators are composed of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainwise.functions.numeric import ratio, wald_bound
from strainwise.session import dealt

BIN_WIDTH = 4096


# ------------------------------------------------------------------ projections
def apply_mapping(df: DataFrame, mapping: list[tuple[str, str, str]]) -> DataFrame:
    """Project, rename and cast; ``mapping`` holds (source, target, type).  Unfit values become NULL."""
    return df.select(*[F.col(source).try_cast(kind).alias(target) for source, target, kind in mapping])
#: Copies of the smaller side of a product.
PAIR_SLOTS = 256


def select_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Project on those names the frame has."""
    return df.select(*[name for name in names if name in df.columns])


def rename_field(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def rename_with_suffix(df: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({name: f"{name}{suffix}" for name in columns})


def drop_null_fields(df: DataFrame) -> DataFrame:
    """Drop the columns that hold no value at all (one row of counts comes back, not the data)."""
    counts = df.agg(*[F.count(F.col(name)).alias(name) for name in df.columns]).first()
    return df.drop(*[name for name in df.columns if counts[name] == 0])


def fill_by_column(df: DataFrame, defaults: dict) -> DataFrame:
    return df.na.fill(defaults)


# ------------------------------------------------------------------ joins
def resolve_first(df: DataFrame, key: str, lookups: list[DataFrame], result: str) -> DataFrame:
    """Look ``key`` up in several (name, id) tables; the first table that knows it decides.

    The lookups are merged into one table with one row per name before the single
    join, so a name known to several tables does not multiply rows.
    """
    ranked = None
    for order, lookup in enumerate(lookups):
        name, identifier = lookup.columns[:2]
        part = lookup.select(
            F.col(name).alias("_name"), F.lit(order).alias("_order"), F.col(identifier).alias("_id")
        ).where(F.col("_name").isNotNull() & F.col("_id").isNotNull())
        ranked = part if ranked is None else ranked.unionByName(part)
    best = ranked.groupBy("_name").agg(F.min(F.struct("_order", "_id"))["_id"].alias(result))
    return df.join(best, df[key] == best["_name"], "left").drop("_name")


def join_optional(df: DataFrame, other: DataFrame, key: str, other_key: str, kept: list[str]) -> DataFrame:
    """Left join that is skipped, with NULL results, when ``df`` lacks the key column."""
    if key in df.columns:
        side = other.select(F.col(other_key).alias(key), *kept)
        return df.join(side, key, "left")
    return df.select("*", *[F.lit(None).cast(other.schema[name].dataType).alias(name) for name in kept])


def pair_all(big: DataFrame, small: DataFrame, spread_by: str) -> DataFrame:
    """Every row of ``big`` with every row of ``small``, where that product is the result asked for.

    ``small`` is repeated once per slot and joined on the slot of the big row: an
    ordinary equi join without a broadcast, for which the planner would not count the copies.  The number of partitions is given, as the planner
    would merge them by the size of what goes in, not of what comes out.  A row of ``small`` meets all rows of its slot before the next one
    does: written in this order, its columns are runs and those of ``big`` come again at short distances, which files hold in little space.
    """
    repeated = small.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(PAIR_SLOTS - 1))))
    slotted = big.withColumn("_slot", F.pmod(F.xxhash64(spread_by), F.lit(PAIR_SLOTS)).cast("int"))
    met = dealt(repeated).join(slotted.repartition(PAIR_SLOTS, "_slot"), "_slot")
    return met.select(*[F.col(f"`{c}`") for c in [*big.columns, *small.columns]])


def sample_by_key(df: DataFrame, keys: list[str], fraction: float) -> DataFrame:
    """About ``fraction`` of the rows, the same ones on every run and however the rows are partitioned: those whose key's digest is low."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.where(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") < F.lit(int(fraction * 2**32)))


def with_each(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Every row once per literal value."""
    return df.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def exclude_intervals(
    df: DataFrame, intervals: DataFrame, pad: int = 0, position: str = "position", width: int = BIN_WIDTH
) -> DataFrame:
    """Rows whose position lies in no ``[start_pos - pad, end_pos + pad]``.

    Intervals are cut into fixed position bins and matched on the bin, so the work
    per row is the few intervals of its bin.  ``intervals`` may carry ``chromosome``.
    """
    keys = ["chromosome"] if "chromosome" in intervals.columns else []
    first, last = F.col("start_pos") - pad, F.col("end_pos") + pad
    binned = intervals.select(
        *keys,
        first.alias("_from"),
        last.alias("_to"),
        F.explode(F.sequence(F.floor(first / width), F.floor(last / width))).alias("_bin"),
    ).distinct()
    marked = df.withColumn("_bin", F.floor(F.col(position) / width))
    inside = (marked["_bin"] == binned["_bin"]) & F.col(position).between(binned["_from"], binned["_to"])
    for key in keys:
        inside = inside & (marked[key] == binned[key])
    return marked.join(binned, inside, "left_anti").drop("_bin")


def key_exists(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def key_absent(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


# ------------------------------------------------------------------ best rows
def best_ranked(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Rows with the best rank of their group, ties kept.

    Meant for groups that an aggregation or the domain has already bounded
    (media of one sample and drug, annotations of one variant).
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.rank().over(window)).where("_rank = 1").drop("_rank")


def best_ranked_unbounded(df: DataFrame, keys: list[str], rank: Column) -> DataFrame:
    """As :func:`best_ranked`, for groups of any size: minima are combined map-side and joined back."""
    ranked = df.withColumn("_rank", rank)
    best = ranked.groupBy(*keys).agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, [*keys, "_rank"], "left_semi").drop("_rank")


def top1_per_group(df: DataFrame, keys: list[str], order: list[Column], kept: list[str]) -> DataFrame:
    """One row per group, the one with the smallest ``order``; combined map-side, so hot groups cost nothing extra."""
    sort_key = F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(order)])
    row = F.struct(sort_key.alias("_key"), *kept)
    return df.groupBy(*keys).agg(F.min(row).alias("_best")).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in kept])


def distinct_on(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One full row per key."""
    kept = [name for name in df.columns if name not in keys]
    return top1_per_group(df, keys, order, kept).select(*df.columns)


def mode_with_tiebreak(df: DataFrame, keys: list[str], value: str, unit: str) -> DataFrame:
    """Most frequent ``value`` per group by distinct ``unit``; the smaller value wins ties."""
    counts = df.select(*keys, value, unit).distinct().groupBy(*keys, value).agg(F.count(unit).alias("n"))
    return top1_per_group(counts, keys, [-F.col("n"), F.col(value)], [value, "n"])


def previous_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Next lower distinct value of the group; 0 for the lowest."""
    steps = df.select(*keys, value).distinct()
    window = Window.partitionBy(*keys).orderBy(value)
    return steps.withColumn(name, F.coalesce(F.lag(value).over(window), F.lit(0.0)))


def fill_from_group(df: DataFrame, keys: list[str], column: str, order: str) -> DataFrame:
    """Fill NULL cells with the group's first non-null value by ``order``."""
    first = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys)
        .agg(F.min(F.struct(F.col(order).alias("_o"), F.col(column).alias("_c")))["_c"].alias("_first"))
    )
    return (
        df.join(first, keys, "left").withColumn(column, F.coalesce(F.col(column), F.col("_first"))).drop("_first")
    )


# ------------------------------------------------------------------ aggregates
def count_by_values(df: DataFrame, keys: list[str], column: str, unit: str, values: list[str]) -> DataFrame:
    """Distinct ``unit`` per group, one output column per value of ``column``; absent combinations are 0."""
    distinct = df.select(*keys, column, unit).distinct()
    return distinct.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def count_true_as_all(condition: Column) -> Column:
    """Aggregate: every row satisfies the condition; NULL counts as not satisfied."""
    return F.count_if(condition) == F.count(F.lit(1))


def proportion_ci95(df: DataFrame, hits: Column, total: Column) -> DataFrame:
    """Share in percent with its 95 % normal-approximation interval."""
    share = ratio(hits, total)
    return df.select(
        "*",
        (100 * share).alias("percentage"),
        wald_bound(share, total, -1).alias("interval_lower"),
        wald_bound(share, total, 1).alias("interval_upper"),
    )


def map_by_group(df: DataFrame, key: str, group: str, fields: list[str]) -> DataFrame:
    """Rows to ``map<group, struct<fields>>`` per key; a repeated group keeps one row."""
    one = df.groupBy(key, group).agg(F.max(F.struct(*fields)).alias("_value"))
    entries = F.sort_array(F.collect_list(F.struct(group, "_value")))
    return one.groupBy(key).agg(F.map_from_entries(entries).alias("group_results"))
