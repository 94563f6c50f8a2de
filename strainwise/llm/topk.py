"""Exact top-k search by inner product over quantised vectors, by columnar branch and bound.

Vectors are packed into blocks stored dimension by dimension.  A block of queries meets every block of candidates once; scores are
accumulated over a few dimensions at a time.  What the remaining dimensions can still add is at most the product of
the remaining lengths; candidates that cannot reach a query's k-th best score so far are left behind, and the rest are
compacted before the next dimensions.  All arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Candidates in a block, queries in a block, blocks of candidates a task takes one after the other.
BLOCK_ROWS = 2048
QUERY_ROWS = 8192
BLOCKS_IN_TURN = 8
#: Queries scored together, and dimensions between two looks at the bounds.
CELL_ROWS = 256
STEP = 16


def quantise(vector: Column, factor: int = 64) -> Column:
    """floor(factor * x) of every component, as longs; null where a component is null, not finite or too large for a long."""
    usable = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double") * factor) < 2.0**62), F.lit(False))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row per block: its number, its ids, and its components as one binary, dimension after dimension."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable")
        matrix = np.array(group["vector"].tolist(), np.int64).reshape(len(group), -1)
        return pd.DataFrame({
            name: [group["block"].iloc[0]], "dims": [matrix.shape[1]],
            "ids": [group["id"].to_numpy(np.int64).tobytes()], "columns": [_narrow(matrix.T)],
        })

    placed = rows.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)))
    return placed.groupBy("block", F.size("vector")).applyInPandas(pack, f"{name} long, dims int, ids binary, columns binary")


def _narrow(matrix: np.ndarray) -> bytes:
    """The components in the smallest type of integers that holds them, whose size comes first."""
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if (matrix == matrix.astype(t)).all())
    return bytes([np.dtype(kind).itemsize]) + np.ascontiguousarray(matrix, kind).tobytes()


def _matrix(columns: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(columns, f"<i{columns[0]}", offset=1).reshape(dims, -1)


class Cell:
    """A block of queries with its best candidates so far."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int):
        self.ids, self.columns, self.k = ids, columns, k
        self.lengths = _rest_lengths(columns)
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)  # scores and ids, best first
        self.floor = np.full(len(ids), -np.inf)  # score that a candidate must reach

    def meet(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """Score a block of candidates against all queries of the cell."""
        dims = len(columns)
        small = dims * _largest(self.columns) * _largest(columns)
        if small >= 2.0**62:
            raise OverflowError("scores do not fit a long")
        # All exact; floats multiply faster.
        kind = np.float32 if small < 2.0**23 else np.float64 if small < 2.0**52 else np.int64
        lengths = _rest_lengths(columns)
        alive = np.arange(len(ids))
        scores = np.zeros((len(self.ids), len(ids)), kind)
        queries = self.columns.astype(kind)
        for begin in range(0, dims, STEP):
            part = slice(begin, min(dims, begin + STEP))
            scores += queries[part].T @ columns[part][:, alive].astype(kind)
            if part.stop < dims:
                reach = scores + self.lengths[part.stop][:, None] * lengths[part.stop][alive]
                open_ = (reach >= self.floor[:, None]).any(axis=0)
                if open_.mean() < 0.75:
                    alive, scores = alive[open_], scores[:, open_]
            if not len(alive):
                return
        self._keep(ids[alive], scores)

    def _keep(self, ids: np.ndarray, scores: np.ndarray) -> None:
        wanted = (scores >= self.floor[:, None]) & (ids != self.ids[:, None])
        for q, (best, names) in enumerate(self.rows):
            at = np.flatnonzero(wanted[q])
            if not len(at):
                continue
            value = np.r_[best, scores[q, at].astype(np.int64)]
            name = np.r_[names, ids[at]]
            order = np.lexsort((name, -value))[: self.k]
            self.rows[q] = (value[order], name[order])
            if len(order) == self.k:
                self.floor[q] = value[order[-1]]

    def result(self) -> pd.DataFrame:
        return pd.DataFrame({
            "query_id": np.repeat(self.ids, [len(best) for best, _ in self.rows]),
            "vec_id": np.concatenate([names for _, names in self.rows]),
            "score": np.concatenate([best for best, _ in self.rows]),
        })


def top_k(df: DataFrame, key: str, vector: Column, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` marks, the ``k`` rows of other keys with the highest inner
    products, ties to the smaller key; all of them where there are fewer.

    ``vector`` is an array of longs; rows whose vector or key is null take no part, nor do pairs of vectors of different lengths.
    Rows that share a key are candidates each; a query's own key is never among its results, and queries that share a key and a
    vector are one query (with different vectors under one key, the key's results are drawn from all of them together).
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), vector.alias("vector"), is_query.alias("asks")).filter(
        "id IS NOT NULL AND vector IS NOT NULL"
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    candidate_blocks = max(1, -(-counts["n"] // BLOCK_ROWS))
    query_blocks = max(1, -(-counts["q"] // QUERY_ROWS))
    candidates = _packed(rows.select("id", "vector"), candidate_blocks, "c")
    queries = _packed(rows.filter("asks").select("id", "vector").distinct(), query_blocks, "q").select(
        "q", "dims", F.col("ids").alias("q_ids"), F.col("columns").alias("q_columns")
    )
    # Every block of candidates goes to every block of queries: the scan that the search is, in cells of bounded size.
    cells = candidates.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1).cast("long"))))
    cells = cells.withColumn("turn", F.floor(F.col("c") / BLOCKS_IN_TURN))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        head = group.iloc[0]
        dims = int(head["dims"])
        asked, asked_columns = np.frombuffer(head["q_ids"], np.int64), _matrix(head["q_columns"], dims)
        parts = [slice(at, at + CELL_ROWS) for at in range(0, len(asked), CELL_ROWS)]
        held = [Cell(asked[part], asked_columns[:, part], k) for part in parts]
        for ids, columns in zip(group["ids"], group["columns"]):
            for cell in held:
                cell.meet(np.frombuffer(ids, np.int64), _matrix(columns, dims))
        return pd.concat([cell.result() for cell in held])

    found = (
        cells.join(queries, ["q", "dims"]).groupBy("q", "dims", "turn")
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    # The best of every task are cut down before they are shuffled.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _largest(columns: np.ndarray) -> float:
    return max(float(columns.max(initial=0)), -float(columns.min(initial=0)))


def _rest_lengths(columns: np.ndarray) -> np.ndarray:
    """(dims + 1, rows): length of each vector from each dimension on, a little more for rounding."""
    squares = columns.astype(np.float64) ** 2
    rest = np.zeros((len(columns) + 1, columns.shape[1]))
    rest[:-1] = np.cumsum(squares[::-1], axis=0)[::-1]
    return np.sqrt(rest) * (1 + 1e-9) + 1e-9
