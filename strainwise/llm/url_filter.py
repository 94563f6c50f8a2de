"""URL rules judged by a cascade of Bloom filters, with DataFrame functions only.

A rule is a host and the start of a path.  The keys of a url are all rules that could fit it: its host and parent hosts, with the starts of its path.
The first filter holds the listed keys.  Those keys of the whole corpus that are not listed but pass it are the content of the second,
listed keys that pass the second are the content of the third, and so on until a level lets nothing
false pass.  A key is listed exactly if the first level that refuses it is the second, fourth, ...  As every key of the corpus was taken
into account, membership is exact, and urls are judged without a join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash functions of a filter are taken from two hashes: first + i * second.
WORD_BITS = 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """Bits of one Bloom filter as long words, and how many bits a key sets."""

    words: tuple[int, ...]
    hashes: int


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: then up to ``? #`` or the end.  Null urls and
    those without ``://`` have neither (both empty)."""
    there = F.instr(url, "://") > 0
    rest = F.when(there, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def keys_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The keys of a url, longest first, of the shapes that rules have: numbers of host labels, and lengths of paths."""
    labels = F.split(host, r"\.")
    counts = sorted({rule.host.count(".") + 1 for rule in rules})
    lengths = sorted({len(rule.path) for rule in rules})
    keys = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= m) & (host != ""),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, m)),
        )
        for n in counts for m in lengths
    ]
    # Of equal keys one is enough; among equally long ones the order is that of the text.
    found = F.array_distinct(F.array_compact(F.array(*keys)))
    by_length = F.transform(found, lambda k: F.struct((-F.length(k)).alias("low"), k.alias("key")))
    return F.transform(F.array_sort(by_length), lambda s: s["key"])


def _bit(key: Column, level: int, number: int, bits: int) -> Column:
    first, second = F.xxhash64(F.lit(2 * level), key), F.xxhash64(F.lit(2 * level + 1), key)
    return F.pmod(F.pmod(first, F.lit(bits)) + F.lit(number) * second.bitwiseAND(F.lit(0x7FFFFFFF)), F.lit(bits))


def passes(key: Column, number: int, level: Level) -> Column:
    """Whether a key passes one filter."""
    words = F.from_json(F.lit(str(list(level.words))), "array<bigint>")
    bits = len(level.words) * WORD_BITS

    def is_set(at: Column) -> Column:
        return F.getbit(F.get(words, F.floor(at / WORD_BITS).cast("int")), F.pmod(at, F.lit(WORD_BITS)).cast("int")) == 1

    return reduce(lambda a, b: a & b, [is_set(_bit(key, number, i, bits)) for i in range(level.hashes)])


def listed(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the corpus is listed: levels by turns hold listed and unlisted keys, and the first that refuses tells."""
    answer = F.lit(len(levels) % 2 == 1)
    for number in reversed(range(len(levels))):
        answer = F.when(~passes(key, number, levels[number]), F.lit(number % 2 == 1)).otherwise(answer)
    return answer


def _filter_of(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """A filter that holds all ``key`` of the frame and lets about ``rate`` of others pass.  Its words are made by aggregation;
    they grow with what the level holds, which is bounded by the list."""
    hashes = max(1, round(-log2(rate)))
    words = max(1, ceil(count * hashes * 1.4427 / WORD_BITS))
    places = F.explode(F.array(*[_bit(F.col("key"), number, i, words * WORD_BITS) for i in range(hashes)]))
    one = F.expr(f"shiftleft(1L, CAST(pmod(at, {WORD_BITS}) AS INT))")
    held = (
        keys.select(places.alias("at")).groupBy(F.floor(F.col("at") / WORD_BITS).alias("word"))
        .agg(F.bit_or(one).alias("bits")).collect()
    )
    values = [0] * words
    for row in held:
        values[row["word"]] = row["bits"]
    return Level(tuple(values), hashes)


def build_cascade(keys: DataFrame, list_keys: list[str]) -> list[Level]:
    """Levels for a list over all ``key`` of the corpus (repeats allowed, nulls ignored).

    The first level is so strict that about as many false keys pass it as are listed, whatever the size of the corpus; each
    further one halves what is left.  So later levels, and what the driver sees of them, stay as small as the list.  An empty
    list has no level.
    """
    if not list_keys:
        return []
    spark = keys.sparkSession
    inside = spark.createDataFrame([(k,) for k in sorted(set(list_keys))], "key string")
    total = keys.agg(F.approx_count_distinct("key")).first()[0]
    held, held_count, others = inside, len(set(list_keys)), keys.filter(
        ~F.col("key").isin(*set(list_keys)) & F.col("key").isNotNull()
    )
    levels: list[Level] = []
    while held_count:
        rate = min(0.5, held_count / max(1, total)) if not levels else 0.5
        levels.append(_filter_of(held, held_count, rate, len(levels)))
        false = others.filter(passes(F.col("key"), len(levels) - 1, levels[-1])).distinct()
        # What is false for this level is what the next one holds; what it held is what the next may let pass falsely.
        rows = false.collect()
        held, others = spark.createDataFrame([(r["key"],) for r in rows], "key string"), held
        held_count = len(rows)
    return levels


def judge_urls(df: DataFrame, url: str, rules: list[Rule], otherwise: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (text of the rule that decides, null without one) and ``verdict``.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest fitting rule wins.  Urls that no
    listed key fits get ``otherwise``.  Null urls and urls without ``://`` fit no rule.  Rules listed both ways are refused.
    Repeated rows and other columns stay; columns called like an output are replaced.
    """
    blocked = [r.text for r in rules if r.verdict == "block"]
    allowed = [r.text for r in rules if r.verdict == "allow"]
    if set(blocked) & set(allowed):
        raise ValueError("a rule is listed both ways")
    host, path = host_and_path(F.col(f"`{url}`"))
    outputs = ("host", "path", "rule", "verdict")
    parts = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in outputs], F.col(f"`{url}`").alias("__url"))
    parts = parts.withColumn("host", host).withColumn("path", path).drop("__url")
    keyed = parts.withColumn("__keys", keys_of(F.col("host"), F.col("path"), rules) if rules else F.array().cast("array<string>"))
    universe = keyed.select(F.explode("__keys").alias("key"))
    block, allow = build_cascade(universe, blocked), build_cascade(universe, allowed)

    def stands(levels: list[Level]):
        return lambda key: listed(key, levels) if levels else F.lit(False)

    marked = keyed.withColumn(
        "__hit",
        F.get(
            F.filter(
                F.transform(
                    "__keys",
                    lambda k: F.struct(
                        k.alias("rule"),
                        F.when(stands(block)(k), F.lit("block")).when(stands(allow)(k), F.lit("allow")).alias("verdict"),
                    ),
                ),
                lambda s: s["verdict"].isNotNull(),
            ),
            F.lit(0),
        ),
    )
    return marked.select(
        *[F.col(f"`{c}`") for c in parts.columns], F.col("__hit.rule").alias("rule"),
        F.coalesce("__hit.verdict", F.lit(otherwise)).alias("verdict"),
    )
