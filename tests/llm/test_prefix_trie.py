"""The prefix trie against a plain trie of dictionaries."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from strainwise.llm import prefix_trie, queries

DDL = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    out = []
    for way, members in nodes.items():
        below = [w for w in nodes if w[:len(way)] == way]
        leaves = [w for w in below if not any(len(v) == len(w) + 1 and v[:len(w)] == w for v in below)]
        saved = sum((len(nodes[w]) - 1) * len(w[-1][1]) for w in below if w)
        ends = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(way))
        out.append((
            min(members), len(way), min(nodes[way[:-1]]) if way else None, len(members),
            sum(len(w) == len(way) + 1 for w in below), len(leaves), saved, sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def trie(spark, rows, **settings):
    df = spark.createDataFrame(rows, DDL + ", parent string, `key` int") if rows and len(rows[0]) > 4 else spark.createDataFrame(rows, DDL)
    turns = prefix_trie.number_turns(df, "conv_id", "turn", "role", "text")
    conv = F.col("conv")
    rebuilt = prefix_trie.borrow_starts(turns, conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6, most=5)
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(rebuilt, **settings).collect()), key=repr)


def conversations(seed, convs, words="ab"):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(1000), convs):
        for turn in range(rng.randint(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.1 else "user", rng.choice(words) * 3))
    return rows


@pytest.mark.parametrize("fan, waiting", [(2, 2), (3, 100), (256, 3)])
def test_random_tries(spark, fan, waiting):
    """Small fans make many levels of shards; small queues spill."""
    rows = conversations(1, 90)
    assert trie(spark, rows, fan=fan, waiting=waiting) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (100, None, None, None), (100, 1, "user", "é😀"), (100, 1, "user", "é😀"), (100, 1, "assistant", "x"), (101, 0, "user", ""),
        (None, 0, "user", "left out"), (102, 5, None, "t"), (102, None, "r", None), (-7, 0, "user", "negative"), (3, 0, "u", "v"),
    ] + [(200, 0, "user", "same"), (300, 0, "user", "same"), (400, 0, "user", "same")]
    assert trie(spark, [(*r, "clash", 1) for r in rows], fan=2) == brute(rows)


def test_one_long_conversation_among_many_copies(spark):
    rows = [(1, i, "user", "w") for i in range(300)] + [(c, 0, "user", "w") for c in range(1000, 1400)]
    assert trie(spark, rows, fan=16) == brute(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []


def test_queue_spills_in_order():
    rng = random.Random(5)
    queue, held = prefix_trie.SpillingQueue(limit=4), []
    for _ in range(400):
        if rng.random() < 0.6 or not held:
            item = (rng.randrange(50), rng.randrange(50))
            queue.push(item)
            held.append(item)
        else:
            held.sort()
            assert queue.first() == held[0]
            assert queue.pop() == held.pop(0)
    assert queue.runs > 10
    assert [queue.pop() for _ in range(len(held))] == sorted(held) and queue.first() is None


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op12_prefix_trie(spark, folder).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(rows)
