"""Conversations as training texts: reply trees, their best branches, and a chat template with a loss mask.

With DataFrame functions only.  Paths are found by joining the messages with themselves: after round k every message
knows its ancestor 2^k replies up and the score of the way there, so a conversation of n turns takes log2(n) rounds.  The leaves are ranked by
the score of their paths, and the chosen ones are walked back with the same tables, longest jumps first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strainwise.session import cut_lineage

# Marks of the template (fixed values).
START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """No mark can be spelled in the result: a backslash doubles, and one parts ``<`` from ``|``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def linear_replies(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, node, parent, role, text, score) of conversations without branches: every row answers the one before it.

    The order is that of turn, then role, then text, so ties and repeated rows have places of their own.  Null texts and roles are
    empty; a null turn comes first; rows of a null conversation are one conversation.
    """
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    node = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")).cast("long")
    placed = rows.withColumn("node", node)
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return placed.select("conv", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _ancestors(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables, and what each message's way from the root sums up to.

    Table k: (conv, node, up, steps, total) of the messages that have an ancestor 2^k replies up, with number and score of the messages
    from the node to just below it.  The second result has the same columns for all messages, counted from the root on.  Messages
    that have reached the root take no part in further rounds.
    """
    known = messages.select(F.col("conv").alias("c"), F.col("node").alias("n"))
    own = messages.select("conv", "node", "parent", "score")
    level = cut_lineage(
        own.join(known, own["conv"].eqNullSafe(known["c"]) & (own["parent"] == known["n"]), "left")
        .select("conv", "node", F.col("n").alias("up"), F.lit(1).cast("long").alias("steps"), F.coalesce("score", F.lit(0.0)).alias("total"))
    )
    done, tables = level.filter("up IS NULL"), [level.filter("up IS NOT NULL")]
    longest = messages.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    while not tables[-1].isEmpty():
        if 2 ** (len(tables) - 1) > longest:
            raise ValueError("replies form a circle")
        climbing = tables[-1]
        above = done.union(climbing).select(
            F.col("conv").alias("c"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("steps").alias("s"), F.col("total").alias("t")
        )
        level = cut_lineage(
            climbing.join(above, climbing["conv"].eqNullSafe(above["c"]) & (climbing["up"] == above["n"])).select(
                "conv", "node", F.col("next").alias("up"), (F.col("steps") + F.col("s")).alias("steps"), (F.col("total") + F.col("t")).alias("total")
            )
        )
        done = done.union(level.filter("up IS NULL"))
        tables.append(level.filter("up IS NOT NULL"))
    return tables, done


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, branch, place, node): the messages of each conversation's best ``branches`` root-to-leaf paths, in order of ``place``.

    ``messages`` has conv, node (unique within conv), parent (null, or not there: a root), role, text and score (null counts 0).
    Paths are ranked by the mean score of their messages, then by length, longer first, then by their leaf.
    """
    tables, whole = _ancestors(messages)
    parents = messages.select(F.col("conv").alias("c"), F.col("parent").alias("p")).filter("p IS NOT NULL")
    leaves = whole.join(parents, whole["conv"].eqNullSafe(parents["c"]) & (whole["node"] == parents["p"]), "left_anti")
    order = Window.partitionBy("conv").orderBy(F.desc(F.col("total") / F.col("steps")), F.desc("steps"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= branches)
    walk = chosen.select("conv", "branch", F.col("steps").alias("place"), "node")
    for k in reversed(range(len(tables) - 1)):
        jump = tables[k].select(F.col("conv").alias("c"), F.col("node").alias("n"), "up")
        further = walk.join(jump, walk["conv"].eqNullSafe(jump["c"]) & (walk["node"] == jump["n"])).select(
            "conv", "branch", (F.col("place") - 2**k).alias("place"), F.col("up").alias("node")
        )
        walk = cut_lineage(walk.union(further))  # each round reads the rows so far twice
    return walk


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, branch, formatted, loss): each chosen path as one text of the template, and its loss mask as spans (start, n) of
    code points: the texts of the assistant, without marks."""
    paths = best_paths(messages, branches)
    held = messages.select(F.col("conv").alias("c"), F.col("node").alias("n"), "role", "text")
    turns = paths.join(held, paths["conv"].eqNullSafe(held["c"]) & (paths["node"] == held["n"]))
    head, body = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEPARATOR)), escape(F.col("text"))
    pieces = turns.select(
        "conv", "branch", "place", "role", F.concat(head, body, F.lit(END)).alias("piece"),
        F.length(head).alias("lead"), F.length(body).alias("n"),
    )
    upto = Window.partitionBy("conv", "branch").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = pieces.withColumn(
        "start", F.sum(F.length("piece")).over(upto) - F.length("piece") + F.col("lead")
    )
    item = F.struct("place", "piece", F.when(F.col("role") == LEARNED, F.struct("start", "n")).alias("span"))
    grouped = placed.groupBy("conv", "branch").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return grouped.select(
        "conv", "branch", F.array_join(F.transform("items", lambda i: i["piece"]), "").alias("formatted"),
        F.array_compact(F.transform("items", lambda i: i["span"])).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    ended = F.split(formatted, r"<\|im_end\|>")
    return F.transform(
        F.slice(ended, 1, F.size(ended) - 1),
        lambda turn: F.struct(
            unescape(F.substring(F.substring_index(turn, SEPARATOR, 1), len(START) + 1, 2**31 - 1)).alias("role"),
            unescape(F.substring_index(turn, SEPARATOR, -1)).alias("text"),
        ),
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, in order, without escapes."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["n"]))), ""
    )
