"""The prefix trie of conversations: what begins alike is one path, with totals of every subtree by time-forward processing.

A node is a sequence of turns; its key is a digest that every turn extends, so no text travels further than the numbering of turns.
Subtree totals go from the leaves to the root as messages to parents.  Nodes are cut into shards, sorted externally by reverse level
order (deepest first) within them, and processed in that order; a message waits in a priority queue, ordered the same way, until
its parent's turn comes.  The roots of the shards then send their totals across shards, to shards of a higher level.

The level of a node is the logarithm of its number of conversations, rounded down.  It never falls towards the root, so a shard is
a subtree of nodes of one level, and no more than ``FAN`` nodes of one depth can stand in it, however many conversations begin
alike.  The number of levels, and of rounds, is that of the digits of the number of conversations.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strainwise.session import cut_lineage

#: Base of the logarithm that makes levels; bounds the nodes of one depth in a shard.
FAN = 256
#: Messages a queue holds in memory before it writes a sorted run.
WAITING = 1 << 16
#: Conversations whose numbers are joined in one piece before they are digested.
PIECE = 1 << 16
ROOT = bytes(16)


def number_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos, said, chars): place of every turn from 0, digest of role and text, code points of the text.

    Turns are ordered by ``turn``, null first, then by role and text, so ties are settled; null role or text is empty.  Rows without a
    conversation belong to none and are left out; repeated rows are turns like any other.
    """
    spoken = df.filter(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return spoken.select(
        "conv", (F.row_number().over(order) - 1).alias("pos"), said.alias("said"), F.length("text").cast("long").alias("chars")
    )


def borrow_starts(turns: DataFrame, hub: Column, borrowed: Column, most: int) -> DataFrame:
    """Turns of conversations rebuilt: the first ``borrowed`` turns of the conversation ``hub``, then the own ones after as many.

    Both columns are functions of ``conv``; ``borrowed`` is ``most`` at most.  A hub that is absent or shorter lends what there is.  One row with a null
    place stands for every conversation, so those left without turns are still there.
    """
    convs = turns.select("conv").distinct().withColumn("hub", hub).withColumn("lent", borrowed)
    starts = turns.filter(F.col("pos") < most).withColumnRenamed("conv", "hub")
    own = turns.withColumn("lent", borrowed).filter("pos >= lent").select("conv", "pos", "said", "chars")
    first = convs.join(starts, "hub").filter("pos < lent").select("conv", "pos", "said", "chars")
    none = convs.select("conv", F.lit(None).cast("int").alias("pos"), F.lit(None).cast("binary").alias("said"), F.lit(0).cast("long").alias("chars"))
    return own.union(first).union(none)


def trace_paths(turns: DataFrame) -> DataFrame:
    """(key, parent, conv, depth, chars, ends): the nodes on the way of every conversation, the root first; ``ends`` where it ends.

    Rows of a conversation stream through a task in order; nothing of them is held but the last row.
    """
    kind = turns.schema["conv"].dataType.simpleString()

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            out = []
            for conv, said, chars in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if waiting and waiting[2] == conv:
                    if said is None:
                        continue
                    out.append((*waiting, False))
                    waiting = (sha256(waiting[0] + said).digest()[:16], waiting[0], conv, waiting[3] + 1, chars)
                else:
                    if waiting:
                        out.append((*waiting, True))
                    waiting = (ROOT, None, conv, 0, 0)
                    if said is not None:
                        out.append((*waiting, False))
                        waiting = (sha256(ROOT + said).digest()[:16], ROOT, conv, 1, chars)
            yield rows(out)
        if waiting:
            yield rows([(*waiting, True)])

    types = [pa.binary(), pa.binary(), _arrow(turns.schema["conv"].dataType), pa.int64(), pa.int64(), pa.bool_()]
    names = ["key", "parent", "conv", "depth", "chars", "ends"]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    in_order = turns.select("conv", "pos", "said", "chars").repartition("conv").sortWithinPartitions("conv", F.col("pos").asc_nulls_first())
    return in_order.mapInArrow(trace, f"key binary, parent binary, conv {kind}, depth long, chars long, ends boolean")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def shard_nodes(paths: DataFrame, fan: int = FAN) -> DataFrame:
    """(key, parent, depth, chars, level, shard, conv, n_convs): the distinct nodes; ``shard`` is the key of the shard's topmost node."""
    heavy = paths.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") >= fan)
    powers = [p for p in (fan**k for k in range(1, 64)) if p < 2**63]
    level = reduce(lambda total, p: total + (F.col("n") >= p).cast("int"), powers, F.lit(0))
    levels = cut_lineage(heavy.select("key", level.alias("level")))
    on_way = paths.join(levels, "key", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    same = Window.partitionBy("conv", "level").orderBy("depth")
    placed = on_way.withColumn("shard", F.first("key").over(same))
    return placed.groupBy("key", "parent", "depth", "chars", "level", "shard").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs")
    )


class SpillingQueue:
    """A priority queue that holds ``limit`` items in memory; beyond that, all of them become a sorted run.

    Runs are files without a name that only this task can see and that vanish with it: what a lost task had is made again.
    """

    def __init__(self, limit: int = WAITING):
        self.limit = limit
        self.heap: list = []
        self.heads: list = []  # (first item left, number of the run, file)
        self.runs = 0

    def push(self, item) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            run = tempfile.TemporaryFile()
            for each in sorted(self.heap):
                pickle.dump(each, run, pickle.HIGHEST_PROTOCOL)
            run.seek(0)
            self.heap = []
            self.runs += 1
            self._advance(self.runs, run)

    def _advance(self, number: int, run) -> None:
        try:
            heapq.heappush(self.heads, (pickle.load(run), number, run))
        except EOFError:
            run.close()

    def first(self):
        """The smallest item, or None."""
        items = [q[0] for q in (self.heap,) if q] + [q[0][0] for q in (self.heads,) if q]
        return min(items, default=None)

    def pop(self):
        if self.heads and not (self.heap and self.heap[0] <= self.heads[0][0]):
            item, number, run = heapq.heappop(self.heads)
            self._advance(number, run)
            return item
        return heapq.heappop(self.heap)


SETTLED = "key binary, parent binary, top boolean, n_children long, n_leaves long, saved_tokens long"


def settle_shards(nodes: DataFrame, waiting: int = WAITING) -> DataFrame:
    """Subtree totals of nodes of whole shards (key, parent, depth, shard, own, and what came from other shards: children, leaves, saved).

    Sorted by Spark, a task sees its shards one after the other, deepest nodes first.
    """

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(waiting)
        for batch in batches:
            out = []
            for shard, depth, key, parent, own, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                here = (shard, -depth, key)
                while (message := queue.first()) is not None and message[:3] == here:
                    _, _, _, many, more = queue.pop()
                    children, leaves, saved = children + 1, leaves + many, saved + more
                leaves, saved = leaves if children else 1, saved + own
                out.append((key, parent, key == shard, children, leaves, saved))
                if key != shard:
                    queue.push((shard, 1 - depth, parent, leaves, saved))
            types = [pa.binary(), pa.binary(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], [f.split()[0] for f in SETTLED.split(", ")]
            )
        if queue.first() is not None:
            raise RuntimeError("a message found no parent")

    columns = ["shard", "depth", "key", "parent", "own", "children", "leaves", "saved"]
    in_order = nodes.select(*columns).repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "key")
    return in_order.mapInArrow(settle, SETTLED)


def subtree_totals(nodes: DataFrame, waiting: int = WAITING) -> DataFrame:
    """(key, n_children, n_leaves, saved_tokens) of all nodes, a level of shards after the other; messages across shards are summed by
    parent before they travel."""
    highest = nodes.agg(F.max("level")).first()[0]
    own = nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("chars"))
    done: list[DataFrame] = []
    for level in range((highest or 0) + 1):
        part = own.filter(F.col("level") == level)
        if done:
            sent = reduce(DataFrame.union, done).filter("top").groupBy(F.col("parent").alias("key")).agg(
                F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
            )
            part = part.join(sent, "key", "left")
        else:
            part = part.select("*", *[F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")])
        done.append(cut_lineage(settle_shards(part.na.fill(0, ["children", "leaves", "saved"]), waiting)))
    return reduce(DataFrame.union, done).select("key", "n_children", "n_leaves", "saved_tokens")


def digest_ends(paths: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end: their numbers ascending, joined by commas.

    Numbers are joined in pieces of bounded ranges; a digest reads the pieces of its node one after the other and holds one."""
    piece = F.floor(F.col("conv") / PIECE)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = paths.filter("ends").groupBy("key", piece.alias("piece")).agg(joined.alias("said"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for of, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if of != key:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = of, sha256(said.encode())
                else:
                    state.update(b"," + said.encode())
            yield rows(out)
        if state:
            yield rows([(key, state.hexdigest())])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], ["key", "ends_sha256"]
        )

    in_order = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "said")
    return in_order.mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, fan: int = FAN, waiting: int = WAITING) -> DataFrame:
    """One row per node of the trie of the conversations' ``turns`` (see :func:`number_turns`, :func:`borrow_starts`).

    (conv, depth, parent_conv, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): the smallest conversation that begins so, number of turns, the
    parent's smallest conversation (null for the root), conversations that begin so, children, childless nodes of the subtree
    (itself included), the sum over the subtree of (n_convs - 1) times the code points of the last text, and the digest of the conversations that end here
    (of the empty text if none).  No conversations, no rows.  Conversations are numbered by whole numbers.
    """
    paths = cut_lineage(trace_paths(turns))
    nodes = cut_lineage(shard_nodes(paths, fan))
    totals = subtree_totals(nodes, waiting)
    above = nodes.select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv"))
    return (
        nodes.join(totals, "key").join(digest_ends(paths), "key", "left").join(above, "parent", "left")
        .select(
            "conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
