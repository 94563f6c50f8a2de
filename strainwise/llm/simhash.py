"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked where few bits differ.

Two fingerprints that differ in at most ``max_bits`` bits agree in at least ``8 - max_bits`` of their eight bytes, at the same
positions.  The inverted index lists fingerprints by what they hold at three positions jointly; the position triples are
chosen so that whoever agrees in the guaranteed number of bytes shares at least one of them.  Pairs that meet in a list are
tallied over all eight positions, those below the guaranteed count are dropped, and the rest are verified bit by bit.

Lists longer than ``longest_list`` (one crowded neighbourhood of fingerprints) are not paired.  Fingerprints that stand in such a list meet
at their midpoints instead: two values at most 2r bits apart share a value at most r bits from both, and any two
that share one are at most 2r bits apart.  So stars around the midpoints give exactly the components that all pairs would, with a fixed
number of rows per fingerprint whatever the size of the neighbourhood.

Texts that share four fifths of their shingles differ in too many of 64 bits for that guarantee.  :func:`similar_documents`
therefore indexes wider fingerprints: lists by two byte positions and one of the smallest mixed hashes jointly, a tally of the bytes that two
fingerprints share, and a verification of the pairs that reach the least tally, here by the sets of shingles themselves.  Unrelated sets share no
smallest hash, so however many documents there are, they meet in no list; bytes alone are few enough to be met by chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strainwise.llm.components import connected_components
from strainwise.session import Stages, cut_lineage, dealt

SEED = 42
#: Least similarity of sets of shingles, as a fraction.
OVER, UNDER = 4, 5
#: Longs of a wide fingerprint, lists in which each stands, and equal bytes that make a candidate.  Sets of similarity 0.8 share 17 of 64
#: bytes and four fifths of the smallest hashes on average, unrelated ones a quarter of a byte and none.
WIDE = 8
LISTS = 96
LEAST = 8
_MIXES = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) for k in range(WIDE)], np.uint64)


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included, as rows of eight bytes, the highest first; no rows for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    line = b" ".join(found)
    if len(found) <= words:
        hashes = xxhash.xxh64_digest(line, SEED) if found else b""
    else:
        ends = (np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1).tolist()
        starts = [0] + [e + 1 for e in ends[:-1]]
        digest = xxhash.xxh64_digest
        hashes = b"".join([digest(line[a:b], SEED) for a, b in zip(starts, ends[words - 1:])])
    return np.frombuffer(hashes, np.uint8).reshape(-1, 8)


def _majority(hashes: np.ndarray) -> bytes:
    """Bits set in more than half of the rows."""
    bits = np.unpackbits(hashes, axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.uint32) > len(bits)).tobytes()


def fingerprint_of(text: str | None, words: int) -> int:
    """Unsigned fingerprint of one text."""
    hashes = shingle_hashes(text, words)
    return int.from_bytes(_majority(hashes), "big") if len(hashes) else 0


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct hashes of the shingles, ascending as unsigned numbers."""
    return np.unique(shingle_hashes(text, words).view(">u8").ravel().astype(np.uint64))


def simhash(text: Column, words: int = 5) -> Column:
    """Fingerprint of the shingles of ``words`` words as a long (the 64 bits, signed).

    Fewer words are one shingle; a null text, an empty one or one without words has fingerprint zero.
    """

    @F.arrow_udf("long")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.fromiter((fingerprint_of(t.as_py(), words) for t in batch), np.uint64, len(batch))
            yield pa.array(values.view(np.int64))

    return compute(text)


def covering(positions: int, agree: int) -> list[tuple[int, ...]]:
    """Position triples such that every ``agree`` positions contain one of them (all triples for three; for four and more
    Turan's construction: triples inside a third, and those with two in one third and one in the next)."""
    if agree < 3:
        raise ValueError("fingerprints must agree in three bytes at least: allow 5 differing bits or fewer")
    everything = list(combinations(range(positions), 3))
    if agree == 3:
        return everything
    third = [p * 3 // positions for p in range(positions)]

    def fits(triple: tuple[int, ...]) -> bool:
        parts = [third[p] for p in triple]
        return any(
            parts.count(g) == 3 or parts.count(g) == 2 and parts.count((g + 1) % 3) == 1 for g in range(3)
        )

    return [t for t in everything if fits(t)]


def byte_at(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def postings(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """(list, fp): the lists of the index in which each fingerprint stands."""
    fp = F.col("fp")
    keys = [
        reduce(lambda acc, p: F.shiftleft(acc, 8).bitwiseOR(byte_at(fp, p)), triple, F.lit(number).cast("long"))
        for number, triple in enumerate(covering(8, 8 - max_bits))
    ]
    return fingerprints.select(F.explode(F.array(*keys)).alias("list"), "fp")


def midpoints(fingerprints: DataFrame, radius: int) -> DataFrame:
    """(middle, fp): all values at most ``radius`` bits from a fingerprint."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    flips = F.from_json(F.lit(str(signed)), "array<bigint>")
    return fingerprints.select(F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("middle"), "fp")


def link_fingerprints(fingerprints: DataFrame, max_bits: int = 4, longest_list: int = 256) -> DataFrame:
    """Links (src, dst), src < dst, between distinct fingerprints ``fp``, whose components are those of all pairs that differ in at most
    ``max_bits`` bits.  Every link but those of stars is such a pair; two members of a star have a chain of such pairs.
    """
    index = postings(fingerprints, max_bits)
    sizes = index.groupBy("list").agg(F.count("*").alias("n")).filter("n > 1")
    met = cut_lineage(dealt(index).join(sizes, "list"))
    short = met.filter(F.col("n") <= longest_list).select("list", "fp")
    other = short.select(F.col("list"), F.col("fp").alias("dst"))
    left = dealt(short.withColumnRenamed("fp", "src"))
    same = sum(
        ((byte_at(F.col("src"), p) == byte_at(F.col("dst"), p)).cast("int") for p in range(8)), F.lit(0)
    )
    differing = F.bit_count(F.col("src").bitwiseXOR(F.col("dst")))
    pairs = left.join(
        other,
        (left["list"] == other["list"]) & (F.col("src") < F.col("dst")) & (same >= 8 - max_bits) & (differing <= max_bits),
    ).select("src", "dst")
    crowded = met.filter(F.col("n") > longest_list).select("fp").distinct()
    # An odd number of bits: one side keeps to a radius one smaller, so the midpoint stays within both.
    return pairs.union(_stars(crowded, max_bits)).distinct()


def _stars(crowded: DataFrame, max_bits: int) -> DataFrame:
    if max_bits % 2:
        raise ValueError("crowded lists are linked by midpoints, which need an even number of bits")
    middles = cut_lineage(midpoints(crowded, max_bits // 2))
    centre = middles.groupBy("middle").agg(F.min("fp").alias("src"), F.count("*").alias("n")).filter("n > 1")
    return (
        dealt(middles).join(centre.drop("n"), "middle").filter("src < fp").select("src", F.col("fp").alias("dst"))
    )


def near_duplicates(
    df: DataFrame, key: str, text: str, words: int = 5, max_bits: int = 4, longest_list: int = 256
) -> DataFrame:
    """(key, fp, component): fingerprint of every row's whole text, and the smallest key reachable over links.

    Equal fingerprints are linked; rows without words have fingerprint zero and are linked like any other.  One row per row of
    the input, repeated keys included.  Only key and text are read, so further columns do not matter.
    """
    prints = cut_lineage(df.select(F.col(f"`{key}`").alias("key"), simhash(F.col(f"`{text}`"), words).alias("fp")))
    distinct = prints.groupBy("fp").agg(F.min("key").alias("key"))
    links = link_fingerprints(distinct.select("fp"), max_bits, longest_list)
    named = connected_components(links)
    smallest = (
        dealt(distinct).join(named.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
    )
    # Fingerprints without links are components of their own; only linked ones need the smallest key of their component.
    lowest = smallest.groupBy("component").agg(F.min("key").alias("lowest"))
    of_print = dealt(smallest).join(lowest, "component").select("fp", F.col("lowest").alias("component"))
    return dealt(prints).join(of_print, "fp").select("key", "fp", "component")


def _wide_print(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``WIDE`` longs whose bits are those that most of the distinct hashes set, each long after another mixing of the hashes, and the
    smallest hash of each mixing."""
    sums = np.zeros(64 * WIDE, np.int64)
    least = np.full(WIDE, np.iinfo(np.uint64).max)
    for begin in range(0, len(hashes), 1 << 13):
        mixed = hashes[begin:begin + (1 << 13), None] * _MIXES[None, :]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        least = np.minimum(least, mixed.min(axis=0))
        sums += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * sums > len(hashes)).view(np.int64), least.view(np.int64)


def wide_prints(text: Column, words: int = 5) -> Column:
    """(id, n, print, least) of every text: 128 bits that stand for its set of shingles, the size of the set, its wide fingerprint, and the
    smallest hashes (unsigned)."""

    @F.arrow_udf("struct<id: binary, n: int, print: array<bigint>, least: array<bigint>>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch]
            ids = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
            made = [_wide_print(s) for s in sets]
            prints, least = (pa.array([m[i] for m in made], pa.list_(pa.int64())) for i in (0, 1))
            yield pa.StructArray.from_arrays([ids, pa.array(map(len, sets), pa.int32()), prints, least], ["id", "n", "print", "least"])

    return compute(text)


def shingle_sets(text: Column, words: int = 5) -> Column:
    """The distinct hashes of every text's shingles, in order."""

    @F.arrow_udf("array<bigint>")
    def compute(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingle_set(t.as_py(), words).view(np.int64) for t in batch], pa.list_(pa.int64()))

    return compute(text)


def wide_pairs() -> list[tuple[int, int]]:
    """Pairs of byte positions of the wide fingerprint, ``LISTS`` of them, in which every position stands equally often."""
    rng = np.random.default_rng(SEED)
    rounds = 2 * LISTS // (8 * WIDE)
    return [tuple(t) for t in np.concatenate([rng.permutation(8 * WIDE) for _ in range(rounds)]).reshape(-1, 2).tolist()]


def _wide_postings(docs: DataFrame) -> DataFrame:
    """(list, num): the lists in which each document stands, by what its fingerprint holds at two positions and one of its smallest hashes
    jointly.  Smallest hashes take turns."""
    pairs = np.array(wide_pairs())
    turn = np.arange(len(pairs)) % WIDE

    @F.arrow_udf("array<bigint>")
    def lists(prints: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, least in prints:
            held = batch.flatten().to_numpy(zero_copy_only=False).view(np.uint8).reshape(len(batch), 8 * WIDE).astype(np.uint64)
            keys = np.arange(len(pairs), dtype=np.uint64) << np.uint64(16)
            for shift, places in zip((8, 0), pairs.T):
                keys = keys | (held[:, places] << np.uint64(shift))
            # The product wraps; it takes list and bytes apart from the hash they are added to.
            keys = keys * _MIXES[0] + least.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(batch), WIDE)[:, turn]
            yield pa.ListArray.from_arrays(np.arange(0, keys.size + 1, len(pairs), dtype=np.int32), pa.array(keys.view(np.int64).ravel()))

    # Outer, though no array is empty: a plain explode has the planner ask for the lists twice, once to look for empty ones.
    return docs.select(lists("print", "least").alias("lists"), "num").select(F.explode_outer("lists").alias("list"), "num")


def _shared_bytes(a: Column, b: Column) -> Column:
    """The tally: positions at which both fingerprints hold the same byte."""
    differing = []
    for x in (a[i].bitwiseXOR(b[i]) for i in range(WIDE)):
        # The lowest bit of every byte becomes one if any of its bits is.
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask))
        differing.append(F.bit_count(x))
    return F.lit(8 * WIDE) - reduce(lambda x, y: x + y, differing)


def _verified(pairs: DataFrame, docs: DataFrame, bodies: DataFrame, words: int, stages: Stages) -> DataFrame:
    """(src, dst) of the pairs whose sets of shingles are similar; sets are made for the documents of pairs only."""
    wanted = pairs.select(F.explode(F.array("src", "dst")).alias("num")).distinct().join(dealt(docs.select("num", "of")), "num")
    held = dealt(bodies).join(wanted, (bodies["version"] == F.col("of.version")) & bodies["key"].eqNullSafe(F.col("of.key")))
    # Equal rows of the input hold the same text.
    found = stages.cut(held.dropDuplicates(["num"]).select("num", shingle_sets(F.col("body"), words).alias("shingles")))
    one = found.select(F.col("num").alias("src"), F.col("shingles").alias("a"))
    two = found.select(F.col("num").alias("dst"), F.col("shingles").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    similar = (OVER + UNDER) * shared >= OVER * (F.size("a") + F.size("b"))
    links = stages.cut(pairs.join(dealt(one), "src").join(dealt(two), "dst").filter(similar).select("src", "dst"))
    stages.drop(found)
    return links


def link_documents(docs: DataFrame, bodies: DataFrame, words: int, least: int, stages: Stages) -> DataFrame:
    """(node, component) over ``num`` of the documents of distinct sets (num, of, n, print, least) that similar candidates chain together.

    Documents that share a list of the index, and at least ``least`` bytes at equal positions, are candidates.  In every list
    all documents meet the list's first one, and of a document's candidates the one with most shared bytes is verified first; so a
    crowd of near copies falls together with one verification each.  Then every list is asked for candidates in different components so
    far, and all of these are verified.  What is skipped is what is linked already.
    """
    prints = docs.select("num", "print")
    index = _wide_postings(docs)
    company = index.groupBy("list").agg(F.min("num").alias("lead"), F.count("*").alias("many")).filter("many > 1")
    met = stages.cut(dealt(index).join(company.select("list", "lead"), "list"))
    src, dst = (dealt(prints.select(F.col("num").alias(n), F.col("print").alias(f"{n}_print"))) for n in ("src", "dst"))
    stars = met.filter("num <> lead").select(F.col("lead").alias("src"), F.col("num").alias("dst")).distinct()
    tally = _shared_bytes(F.col("src_print"), F.col("dst_print"))
    tallied = stages.cut(
        stars.join(src, "src").join(dst, "dst").select("src", "dst", tally.alias("tally")).filter(F.col("tally") >= least)
    )
    nearest = tallied.groupBy("dst").agg(F.max(F.struct("tally", "src")).alias("best")).select(F.col("best.src").alias("src"), "dst")
    first = _verified(stages.cut(nearest), docs, bodies, words, stages)

    so_far = connected_components(first).withColumnRenamed("node", "num")
    placed = dealt(met).join(so_far, "num", "left").withColumn("component", F.coalesce("component", "num"))
    mixed = placed.groupBy("list").agg(F.min("component").alias("a"), F.max("component").alias("b")).filter("a <> b").select("list")
    open_ = stages.cut(dealt(placed).join(mixed, "list").join(dealt(prints), "num").select("list", "num", "component", "print"))
    # Of two documents of different components, one is outside the list's largest.
    sizes = open_.groupBy("list", "component").agg(F.count("*").alias("many"))
    largest = sizes.groupBy("list").agg(F.max(F.struct("many", "component"))["component"].alias("largest"))
    outside = dealt(open_).join(largest, "list").filter("component <> largest").drop("largest")
    one, two = (
        side.select(F.col("list").alias(f"{n}_list"), *[F.col(c).alias(f"{n}_{c}") for c in ("num", "component", "print")])
        for side, n in ((outside, "src"), (open_, "dst"))
    )
    apart = dealt(one).join(
        two, (F.col("src_list") == F.col("dst_list")) & (F.col("src_component") != F.col("dst_component")) & (tally >= least)
    )
    bridges = stages.cut(
        apart.select(F.least("src_num", "dst_num").alias("src"), F.greatest("src_num", "dst_num").alias("dst")).distinct()
        .join(dealt(nearest), ["src", "dst"], "left_anti")
    )
    second = _verified(bridges, docs, bodies, words, stages)
    return connected_components(first.union(second))


def similar_documents(df: DataFrame, key: str, text: str, words: int = 5, least: int = LEAST) -> DataFrame:
    """(key, version, component): documents in one component are chained by candidate pairs whose sets of shingles of ``words``
    words have a Jaccard similarity of four fifths or more; no other pairs count.

    ``version`` is a hash of the text; ``component`` is the smallest (key, version) reachable.  Equal sets are always together, and so are texts
    without words.  Candidates are found by fingerprints, so a similar pair may be missed; see README for the measured recall.
    """
    body = F.col(f"`{text}`")
    bodies = df.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("version"), body.alias("body"))
    with Stages(df.sparkSession) as stages:
        sets = stages.cut(bodies.select("key", "version", wide_prints(F.col("body"), words).alias("s")).select("key", "version", "s.*"))
        distinct = stages.cut(
            sets.groupBy("id").agg(
                F.min(F.struct("key", "version")).alias("of"), F.first("n").alias("n"), F.first("print").alias("print"), F.first("least").alias("least")
            ).withColumn("num", F.monotonically_increasing_id())
        )
        named = link_documents(distinct.filter("n > 0"), bodies, words, least, stages)
        whole = (
            dealt(distinct.select("id", "num", "of")).join(named.withColumnRenamed("node", "num"), "num", "left")
            .withColumn("component", F.coalesce("component", "num"))
        )
        lowest = whole.groupBy("component").agg(F.min("of").alias("lowest"))
        of_set = dealt(whole).join(lowest, "component").select("id", F.col("lowest").alias("component"))
        return cut_lineage(dealt(sets.select("key", "version", "id")).join(of_set, "id").select("key", "version", "component"))


def keep_one_of_each(df: DataFrame, key: str, text: str, **settings) -> DataFrame:
    """One row of every component of :func:`similar_documents`: the first by key, then by text version; equal rows count as one."""
    found = similar_documents(df, key, text, **settings)
    first = found.filter(F.struct("key", "version") == F.col("component"))
    repeated = first.count() > first.distinct().count()
    chosen = first.select(F.col("key").alias("__key"), F.col("version").alias("__version")).distinct()
    of = F.xxhash64(F.col(f"`{text}`"))
    kept = df.join(dealt(chosen), F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (of == F.col("__version")), "left_semi")
    if not repeated:
        return kept
    # Several rows under one key with the same text: any further columns decide which stays.
    order = Window.partitionBy(F.col(f"`{key}`"), of).orderBy(*[F.col(f"`{c}`") for c in df.columns if c not in (key, text)])
    return kept.withColumn("__at", F.row_number().over(order)).filter("__at = 1").drop("__at")
