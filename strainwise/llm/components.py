"""Connected components of a link table: links are joined within every task, then by alternating neighbour minima; every round is
written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainwise.session import Stages

#: Links that a task joins at a time.
CHUNK = 1 << 19


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node that has a link; ``component`` is the smallest node reachable.

    Every task first joins the links it reads, so that small tables are nearly done without a shuffle.  Large-star and small-star steps
    then alternate with that until every node but the smallest has one link, to the smallest (logarithmically many rounds in practice).  Each step
    is a minimum per node, combined before the shuffle, and one equi join, so a node with very many links is never gathered; the adaptive
    join splits it.  Loops are ignored; no links give no rows.
    """
    with Stages(links.sparkSession) as stages:
        edges = stages.cut(
            links.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter("u <> v").distinct()
        )
        while True:
            joined = stages.cut(_join_in_tasks(edges))
            stages.drop(edges)
            nodes = stages.cut(_ends(joined))
            # Done when all links are those of stars: to one smaller node each, which has no smaller one itself.
            if not nodes.agg(F.count(F.when(F.expr("low <> high OR low IS NOT NULL AND inner"), 1))).first()[0]:
                break
            stages.drop(nodes)
            edges = stages.cut(_small_star(_large_star(joined)))
            stages.drop(joined)
        return stages.keep(nodes).select("node", F.coalesce("low", "node").alias("component"))


def _ends(edges: DataFrame) -> DataFrame:
    """(node, low, high, inner): smallest and largest of the smaller nodes each node is linked to, and whether it is linked to a larger one."""
    none = F.lit(None).cast(edges.schema["v"].dataType)
    ends = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("inner")).union(
        edges.select(F.col("v").alias("node"), none.alias("v"), F.lit(True).alias("inner"))
    )
    return ends.groupBy("node").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.max("inner").alias("inner"))


def _join_in_tasks(edges: DataFrame) -> DataFrame:
    """The same components with fewer links: of the links that a task reads at a time, every node keeps one, to the smallest node they chain it to.

    Nodes are whole numbers or structs of them; links of other nodes stay as they are.
    """
    kind = edges.schema["u"].dataType
    if not all(isinstance(k, T.IntegralType) for k in ([f.dataType for f in kind] if isinstance(kind, T.StructType) else [kind])):
        return edges
    chunk = CHUNK

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= chunk:
                yield _stars_of(held)
                held, size = [], 0
        if size:
            yield _stars_of(held)

    return edges.mapInArrow(join, edges.schema)


def _stars_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The links of the batches as stars."""
    schema = held[0].schema
    both = pa.concat_arrays([b.column(i) for i in range(2) for b in held])
    parts = [p.to_numpy() for p in (both.flatten() if pa.types.is_struct(both.type) else [both])]
    # By the first field, then by the next, as Spark orders structs.
    order = np.lexsort(parts[::-1])
    begins = np.concatenate([[True], np.any([p[order][1:] != p[order][:-1] for p in parts], axis=0)])
    names = order[begins]
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(begins) - 1
    lowest = smallest_reachable(*numbers.reshape(2, -1), len(names))
    above = np.flatnonzero(lowest < np.arange(len(names)))

    def column(at: np.ndarray) -> pa.Array:
        return both.take(pa.array(names[at]))

    return pa.RecordBatch.from_arrays([column(above), column(lowest[above])], schema=schema)


def smallest_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the numbers below ``n`` that each is chained to by the links between ``a`` and ``b``."""
    lowest = np.arange(n)
    while True:
        one, two = lowest[a], lowest[b]
        if (one == two).all():
            return lowest
        np.minimum.at(lowest, np.maximum(one, two), np.minimum(one, two))
        while ((further := lowest[lowest]) != lowest).any():
            lowest = further


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or the node)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (
        both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them (edges have u > v)."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    joined = edges.join(lowest, "u")
    return (
        joined.select(F.col("v").alias("u"), F.col("low").alias("v"))
        .union(lowest.select("u", F.col("low").alias("v")))
        .filter("u <> v")
        .distinct()
    )
