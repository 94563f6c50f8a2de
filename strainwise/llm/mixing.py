"""Mixing sources to target weights: which words of which document go to which output shard.

Every source is one stream of words, its documents in hashed order.  The stream is cut into blocks of equal size, smaller ones
where the source is small, so that rounding to blocks is a fixed share of any source.  A source's target becomes a number of blocks (its quota): whole passes over the stream, then a part of one more.  Quotas
are split over the output shards by a tree: at each node the blocks of all sources are divided between the left and the right
shards by one multivariate hypergeometric draw, so every shard is a fair sample of the mix and the quotas stay exact.  A keyed
permutation of the block numbers then deals disjoint blocks to the shards, which are shuffled one by one.

Only totals by source reach the driver: a mix names its sources one by one, so their number is that of the recipe.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source whose places are numbered together.
BUCKET_ROWS = 5000
#: A source has about so many blocks at least, if it has as many words.
LEAST_BLOCKS = 64
#: The library's hypergeometric draws need fewer blocks than this; blocks grow with the corpus to stay below.
MOST_BLOCKS = 500_000_000


@dataclass(frozen=True)
class Recipe:
    """Weights are dealt to the sources in the order of their names (null last), again and again; together the sources give ``share``
    times all words, none more than ``limit`` times its own."""

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    limit: int = 2
    block_words: int = 256
    shards: int = 64
    seed: int = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], recipe: Recipe) -> list[float]:
    """Share by weight; what a source cannot take is dealt again by weight, until none is above its limit."""
    weight = [float(recipe.weights[i % len(recipe.weights)]) for i in range(len(sizes))]
    caps = [float(recipe.limit * s) for s in sizes]
    left, free, out = recipe.share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        per_weight = left / sum(weight[i] for i in sorted(free))
        full = [i for i in sorted(free) if weight[i] * per_weight > caps[i]]
        if not full:
            for i in free:
                out[i] = weight[i] * per_weight
            break
        for i in full:
            out[i] = caps[i]
            left -= caps[i]
            free.discard(i)
    return out


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """(sources, shards): blocks each shard gets of each source; shards are equal up to one block."""
    total = sum(quotas)
    room = [total // shards + (i < total % shards) for i in range(shards)]
    out = np.zeros((len(quotas), shards), np.int64)
    waiting = [(0, shards, np.array(quotas, np.int64))]
    while waiting:
        low, high, counts = waiting.pop()
        if high - low == 1:
            out[:, low] = counts
            continue
        middle = (low + high) // 2
        draw = np.random.Generator(np.random.PCG64([seed, low, high]))
        first = draw.multivariate_hypergeometric(counts, sum(room[low:middle]), method="marginals")
        waiting += [(low, middle, first), (middle, high, counts - first)]
    return out


def _plan(totals: list[tuple[str | None, int]], recipe: Recipe) -> list[tuple]:
    """One row per source: target, quota of every pass, permutation of every pass, first draw of every shard."""
    sizes = [int(size) for _, size in totals]
    goal = targets(sizes, recipe)
    largest = max(recipe.block_words, -(-int(recipe.limit * sum(sizes)) // MOST_BLOCKS))
    rows, quotas = [], []
    for number, ((_, size), target) in enumerate(zip(totals, goal)):
        block = min(largest, max(1, -(-int(size) // LEAST_BLOCKS)))
        blocks, passes = -(-int(size) // block), []
        for turn in range(recipe.limit):
            part = min(max(target - turn * int(size), 0), int(size))
            passes.append(blocks if part == size else min(blocks, round(part / block)))
        quotas.append(sum(passes))
        draw = np.random.Generator(np.random.PCG64([recipe.seed, number]))
        steps, shifts = [], []
        for _ in range(recipe.limit):
            step = int(draw.integers(1, max(2, blocks)))
            while gcd(step, max(1, blocks)) != 1:
                step += 1
            steps.append(step)
            shifts.append(int(draw.integers(0, max(1, blocks))))
        rows.append([target, block, max(1, blocks), passes, steps, shifts])
    shares = split_quotas(quotas, recipe.shards, recipe.seed)
    starts = np.cumsum(shares, axis=1) - shares
    return [
        (name, int(size), *row, starts[i].tolist()) for i, ((name, size), row) in enumerate(zip(totals, rows))
    ]


PLAN = (
    "__source string, source_size long, target double, __block long, __blocks long, __quota array<long>, "
    "__step array<long>, __shift array<long>, __starts array<long>"
)


def mix(df: DataFrame, key: str, text: str, source: str, recipe: Recipe = Recipe()) -> DataFrame:
    """The columns of ``df``, then ``size`` (words), ``source_size``, ``target`` and ``pieces``: the runs of the document's words that
    the mix takes, as structs (pass, block, shard, first_word, n_words).

    Null and empty texts have size 0 and no pieces.  A null source is a source.  Equal rows are rows of their own.  Reruns agree:
    order and draws depend on keys, texts and the seed only.  Columns called like an output are replaced.
    """
    outputs = ["size", "source_size", "target", "pieces"]
    kept = [c for c in df.columns if c not in outputs]
    name = F.col(f"`{source}`").cast("string")
    sized = df.select(*[F.col(f"`{c}`") for c in kept]).withColumn("__size", word_count(F.col(f"`{text}`"))).withColumn("__of", name)
    per_source = sized.groupBy("__of").agg(F.sum("__size").alias("s"), F.count("*").alias("n")).collect()
    # By code point: the order of the UTF-8 bytes, as Spark sorts strings; a null source last.
    per_source.sort(key=lambda r: (r["__of"] is None, (r["__of"] or "").encode()))
    plan = df.sparkSession.createDataFrame(_plan([(r["__of"], r["s"]) for r in per_source], recipe), PLAN)
    buckets = max([1, *(-(-r["n"] // BUCKET_ROWS) for r in per_source)])

    hashed = sized.withColumn("__hash", F.xxhash64(F.lit(recipe.seed), F.col(f"`{key}`").cast("string"), F.col(f"`{text}`")))
    dealt = hashed.withColumn("__bucket", F.pmod("__hash", F.lit(buckets)))
    # Where each bucket of a source starts in its stream, from sums by bucket; then places inside buckets of bounded size.
    before = Window.partitionBy("__of").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("__of", "__bucket").agg(F.sum("__size").alias("s"))
        .withColumn("__base", F.coalesce(F.sum("s").over(before), F.lit(0)))
        .select(F.col("__of").alias("__o"), F.col("__bucket").alias("__b"), "__base")
    )
    inside = (
        Window.partitionBy("__of", "__bucket").orderBy("__hash", F.col(f"`{key}`"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = dealt.withColumn("__end", F.sum("__size").over(inside))
    joined = placed.join(
        starts, placed["__of"].eqNullSafe(starts["__o"]) & (placed["__bucket"] == starts["__b"])
    ).withColumn("__start", F.col("__base") + F.col("__end") - F.col("__size"))
    planned = joined.join(plan, joined["__of"].eqNullSafe(plan["__source"]))
    return planned.select(
        *[F.col(f"`{c}`") for c in kept], F.col("__size").alias("size"), "source_size", "target",
        _pieces(recipe).alias("pieces"),
    )


def _pieces(recipe: Recipe) -> Column:
    start, size, block = F.col("__start"), F.col("__size"), F.col("__block")
    touched = F.when(
        size > 0, F.sequence(F.floor(start / block).cast("long"), F.floor((start + size - 1) / block).cast("long"))
    ).otherwise(F.array().cast("array<long>"))

    def draw_of(number: Column, turn: int) -> Column:
        place = (number * F.col("__step")[turn] + F.col("__shift")[turn]) % F.col("__blocks")
        taken = F.lit(0).cast("long")
        for t in range(turn):
            taken = taken + F.col("__quota")[t]
        return F.when(place < F.col("__quota")[turn], taken + place)

    def shard_of(draw: Column) -> Column:
        """The last shard that starts at or before the draw, by halving."""
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(recipe.shards.bit_length()))])
        starts = F.col("__starts")
        return F.aggregate(
            steps, F.lit(-1), lambda at, step: F.when(F.get(starts, at + step) <= draw, at + step).otherwise(at)
        )

    def piece(turn: int, number: Column) -> Column:
        first = F.greatest(start, number * block)
        return F.struct(
            F.lit(turn).alias("pass"), number.alias("block"), draw_of(number, turn).alias("shard"),
            (first - start).alias("first_word"),
            (F.least(start + size, (number + 1) * block) - first).alias("n_words"),
        )

    def pieces_of(turn: int) -> Column:
        return F.transform(touched, lambda number: piece(turn, number))

    turns = [pieces_of(turn) for turn in range(recipe.limit)]
    drawn = F.filter(F.concat(*turns), lambda p: p["shard"].isNotNull())
    return F.transform(drawn, lambda p: p.withField("shard", shard_of(p["shard"])))


def taken_words(pieces: Column) -> Column:
    return F.aggregate(pieces, F.lit(0).cast("long"), lambda total, p: total + p["n_words"])


def shard_order(mixed: DataFrame, seed: int = 7) -> DataFrame:
    """One row per piece, in the order in which shards are written: partitioned by shard, blocks shuffled within it, the pieces
    of a block together.  ``piece`` replaces ``pieces``."""
    rows = mixed.withColumn("piece", F.explode("pieces")).drop("pieces")
    turn = F.xxhash64(F.lit(seed), "piece.pass", "piece.block", "source_size", "target")
    return rows.repartition("piece.shard").sortWithinPartitions("piece.shard", turn, "piece.block", "piece.first_word")


def drawn_documents(mixed: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """One row for every document and pass that takes words of it, with the ``columns`` of the input.

    The text is untouched where a pass takes all of it; else it is the words taken, in order, joined by blanks.
    """
    body = F.col(f"`{text}`")
    turns = F.array_distinct(F.transform("pieces", lambda p: p["pass"]))
    rows = mixed.withColumn("__turn", F.explode(turns))
    own = F.filter("pieces", lambda p: p["pass"] == F.col("__turn"))
    words = F.regexp_extract_all(body, F.lit(WORD), F.lit(0))
    cut = F.array_join(
        F.flatten(F.transform(own, lambda p: F.slice(words, (p["first_word"] + 1).cast("int"), p["n_words"].cast("int")))), " "
    )
    return rows.withColumn(text, F.when(taken_words(own) == F.col("size"), body).otherwise(cut)).select(
        *[F.col(f"`{c}`") for c in columns]
    )
