"""Exact and near-duplicate lines over the whole corpus, with DataFrame functions only.

A line of length l is cut into ``edits + 1`` even segments, which are indexed under (l, number of the segment, segment).  If two
lines are within ``edits`` edits, one segment of the shorter survives in the longer, shifted by at most what the edits before and
after it allow; so every line probes the index with exactly those substrings, for every length it may meet.  What meets is
verified by a banded, bit-parallel edit distance.  The lists hold distinct lines, so copies never multiply.  Lines that have company in
a list are joined with their texts at hand, and only pairs that pass the verification leave the join; counts of letters, of which an
edit changes two by one at most, spare most comparisons of lists of many lines with a common third.

Equal lines of any length are found by an aggregation over their hashes; only the join over edits asks for a length.

The identity of a line is 128 bits of hash; the texts of a candidate pair are compared themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise.llm.components import connected_components
from strainwise.session import Stages, cut_lineage, dealt

KEYED = ["key", "version"]
#: Letters that are counted to spare comparisons, eight to a long; frequent ones tell most, any would be right.
COUNTED = "etanisorldugchmp"


def _lines(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(key, version, line_no, line, chars, id, check): all lines that are not blank, and blank ones of ``min_chars`` characters.
    ``version`` tells apart texts that share a key; rows equal in both are one document."""
    body = F.col(f"`{text}`")
    rows = df.select(F.col(f"`{key}`").alias("key"), F.xxhash64(body).alias("version"), F.split(body, "\n").alias("lines"))
    return (
        rows.select("key", "version", F.posexplode("lines").alias("line_no", "line"))
        .withColumn("chars", F.length("line"))
        .filter((F.col("chars") >= min_chars) | _written(F.col("line")))
        .withColumn("id", F.xxhash64("line"))
        .withColumn("check", F.xxhash64(F.lit(1), "line"))
    )


def _written(text: Column) -> Column:
    return F.trim(F.translate(text, "\n\r\t", "   ")) != ""


def _place() -> Column:
    return F.struct("key", "version", "line_no")


def _part(length: Column, segment: int, segments: int) -> tuple[Column, Column]:
    """Start (from 1) and size of a segment of an even partition; the last ones are longer by one where it does not divide."""
    base = F.floor(length / segments).cast("int")
    short = F.lit(segments) - (length - base * segments)
    start = base * (segment - 1) + F.greatest(F.lit(0), F.lit(segment - 1) - short) + 1
    return start.cast("int"), (base + (F.lit(segment) > short).cast("int")).cast("int")


def _entry(line: Column, length: Column, segment: int, edits: int, shift: int) -> Column:
    start, size = _part(length, segment, edits + 1)
    return F.xxhash64(length, F.lit(segment), F.substring(line, start + shift, size))


def _probes(edits: int) -> list[tuple[int, int, int]]:
    """(gap, segment, shift) of all substrings that can equal a segment of a line that is ``gap`` shorter: the shift is bounded by
    the edits to the left of the segment and, seen from the end of the line, by those to its right."""
    found = []
    for gap in range(edits + 1):
        for i in range(1, edits + 2):
            left, right = i - 1, edits + 1 - i
            found += [(gap, i, shift) for shift in range(max(-left, gap - right), min(left, gap + right) + 1)]
    return found


def probe_entries(line: Column, chars: Column, edits: int) -> list[Column]:
    return [_entry(line, chars - gap, i, edits, shift) for gap, i, shift in _probes(edits)]


def unshifted(edits: int) -> list[int]:
    """Numbers of the probes that are the line's own segments: its entries in the index."""
    return [n for n, (gap, _, shift) in enumerate(_probes(edits)) if gap == 0 and shift == 0]


def edit_distance_within(one: Column, other: Column, edits: int) -> Column:
    """Whether two strings are at most ``edits`` edits apart (lengths may differ).

    Equal chunks at both ends are cut off first.  On the rest, the band of ``2 * edits + 1`` diagonals is one word of bits: vertical
    differences move along it one character at a time, and the distance on the last diagonal is followed to the end.
    """
    chunk = 16

    def cut(a: Column, b: Column) -> Column:
        """Number of whole chunks that agree from the start."""
        pieces = F.regexp_extract_all(a, F.lit(f"(?s).{{{chunk}}}"), F.lit(0))
        others = F.regexp_extract_all(b, F.lit(f"(?s).{{{chunk}}}"), F.lit(0))
        differs = F.array_position(F.zip_with(pieces, others, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
        return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(pieces), F.size(others))).cast("int")

    def tail(column: Column, chunks: Column) -> Column:
        return F.substring(column, chunks * chunk + 1, F.length(column))

    def trimmed(pair: Column) -> Column:
        rest = F.struct(tail(pair["a"], cut(pair["a"], pair["b"])).alias("a"), tail(pair["b"], cut(pair["a"], pair["b"])).alias("b"))
        return rest

    def reversed_pair(pair: Column) -> Column:
        return F.struct(F.reverse(pair["a"]).alias("a"), F.reverse(pair["b"]).alias("b"))

    def let(value: Column, body) -> Column:
        """Evaluate ``value`` once and hand it on."""
        return F.element_at(F.transform(F.array(value), body), 1)

    pad = F.repeat(F.lit(" "), F.lit(edits + 1))  # a common end changes no distance and leaves room for the band
    # The shorter one first.
    shorter = F.length(one) <= F.length(other)
    pair = F.struct(F.when(shorter, one).otherwise(other).alias("a"), F.when(shorter, other).otherwise(one).alias("b"))
    return let(
        pair,
        lambda p: let(
            trimmed(p),
            lambda q: let(
                trimmed(reversed_pair(q)),
                lambda r: let(
                    F.struct(F.split(F.concat(r["a"], pad), "").alias("a"), F.split(F.concat(r["b"], pad), "").alias("b")),
                    lambda s: _banded(s["a"], s["b"], edits),
                ),
            ),
        ),
    )


def _banded(a: Column, b: Column, edits: int) -> Column:
    """Band of the edit distance between character arrays, the first no longer than the second, as bits of one word.

    Bit k of the word at step j stands for position ``j - edits + k`` of ``a``; ``vp``/``vn`` hold where the distance grows/falls from
    one position to the next.  The lowest diagonal of the band ends at the last character of ``a``; what is left
    of ``b`` then runs along the last row.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, width - 1
    m, n = F.size(a), F.size(b)

    def step(acc: Column, j: Column) -> Column:
        # Characters of ``a`` in the band that equal the j-th (from 0) of ``b``.
        same = reduce(
            lambda x, y: x.bitwiseOR(y),
            [
                F.coalesce((F.get(a, j - edits + k) == F.get(b, j)).cast("int"), F.lit(0)) * (1 << k)
                for k in range(width)
            ],
        )
        x = F.struct(acc.alias("acc"), same.alias("same"))

        def move(s: Column) -> Column:
            vp, vn, eq = s["acc"]["vp"], s["acc"]["vn"], s["same"]
            d0 = (eq.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(eq).bitwiseOR(vn).bitwiseAND(F.lit(full))

            def after(t: Column) -> Column:
                d, p, q = t["d"], t["p"], t["q"]
                hp = q.bitwiseOR(F.bitwise_not(d.bitwiseOR(p)).bitwiseAND(F.lit(full)))
                hn = d.bitwiseAND(p)
                down = F.shiftright(d, 1)
                inside = j < m - edits
                row = F.lit(top - 1) - (j - (m - edits))  # the bit of the last character of ``a``
                along = F.when(F.getbit(hp, row) == 1, 1).when(F.getbit(hn, row) == 1, -1).otherwise(0)
                moved = F.when(inside, 1 - F.getbit(d, F.lit(top)).cast("int")).otherwise(along)
                return F.struct(
                    hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(full))).alias("vp"),
                    down.bitwiseAND(hp).alias("vn"),
                    (s["acc"]["distance"] + moved).cast("int").alias("distance"),
                )

            return F.element_at(F.transform(F.array(F.struct(d0.alias("d"), vp.alias("p"), vn.alias("q"))), after), 1)

        moved = F.element_at(F.transform(F.array(x), move), 1)
        # The last diagonal never falls, and the last row falls by one a step at most: too far is too far.
        return F.when(acc["distance"] > 2 * edits + (n - m), acc).otherwise(moved)

    start = F.struct(
        F.lit(((1 << (edits + 1)) - 1) << (width - edits - 1)).cast("int").alias("vp"),
        F.lit(0).alias("vn"),
        F.lit(edits).alias("distance"),
    )
    return F.aggregate(F.sequence(F.lit(0), n - 1), start, step)["distance"] <= edits


def _letters(line: Column) -> list[Column]:
    """How often the counted letters stand in the line, a byte each (255 at most), eight to a long."""
    counts = [F.least(F.length(line) - F.length(F.replace(line, F.lit(c), F.lit(""))), F.lit(255)).cast("long") for c in COUNTED]
    return [reduce(lambda acc, n: F.shiftleft(acc, 8).bitwiseOR(n), counts[i:i + 8]) for i in range(0, len(counts), 8)]


def _letters_apart(one: str, other: str) -> Column:
    """Sum of the differences of the counts."""

    def count(side: str, part: int, place: int) -> Column:
        return F.shiftrightunsigned(f"{side}{part}", 8 * place).bitwiseAND(F.lit(255))

    parts = [
        F.abs(count(one, part, i) - count(other, part, i)) for part in range(len(COUNTED) // 8) for i in range(8)
    ]
    return reduce(lambda x, y: x + y, parts)


def near_links(df: DataFrame, key: str, text: str, edits: int, min_chars: int, stages: Stages) -> DataFrame:
    """(src, dst): identities (id, check) of distinct lines that are at most ``edits`` edits apart, each pair once.

    The texts are dealt by ``id`` once, copies combined before; their entries come from there, and the texts of lines with company in a
    list are taken from the same shuffle.  Whoever leaves the join of the lists is verified, whatever the length of a list.  Of different
    lines with one 64-bit ``id``, the smallest text takes part.
    """
    lines = _lines(df, key, text, min_chars).filter(F.col("chars") >= min_chars)
    distinct = lines.groupBy("id").agg(F.min("line").alias("line"))
    line = F.col("line")
    # The probes of the own length without a shift are a line's entries in the index.
    own = set(unshifted(edits))
    probes = [p.alias(f"p{i}") for i, p in enumerate(probe_entries(line, F.length("line"), edits))]
    entry = F.explode(F.array(*[
        F.struct(F.col(f"p{i}").alias("entry"), F.lit(i in own).alias("indexed")) for i in range(len(probes))
    ]))
    # Entries are dealt to their lists once, for finding the lists of different lines and for their members.
    entries = distinct.select("id", *probes).select(entry.alias("e"), "id").select("e.entry", "e.indexed", "id").repartition("entry")
    company = entries.groupBy("entry").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.max(F.col("indexed").cast("int")).alias("held")
    ).filter("low < high AND held = 1")
    counts = [c.alias(f"letters{i}") for i, c in enumerate(_letters(line))]
    members = dealt(entries).join(company.select("entry"), "entry").join(dealt(distinct), "id")
    told = stages.cut(members.select(
        "entry", "indexed", F.struct("id", F.xxhash64(F.lit(1), "line").alias("check")).alias("id"), "line",
        F.length("line").alias("chars"), *counts,
    ))

    def side(name: str, rows: DataFrame) -> DataFrame:
        return rows.drop("indexed").select([F.col(c).alias(f"{name}_{c}") for c in rows.drop("indexed").columns])

    # The index side is the shorter line; of equally long ones, each pair is met once.
    ordered = (F.col("one_chars") < F.col("other_chars")) | (
        (F.col("one_chars") == F.col("other_chars")) & (F.col("one_id") < F.col("other_id"))
    )
    near = (F.col("other_chars") - F.col("one_chars") <= edits) & (_letters_apart("one_letters", "other_letters") <= 2 * edits)
    links = stages.cut(
        dealt(side("one", told.filter("indexed"))).join(side("other", told), (
            (F.col("one_entry") == F.col("other_entry")) & ordered & near
            & edit_distance_within(F.col("one_line"), F.col("other_line"), edits)
        )).select(F.least("one_id", "other_id").alias("src"), F.greatest("one_id", "other_id").alias("dst")).distinct()
    )
    stages.drop(told)
    return links


def line_classes(df: DataFrame, key: str, text: str, edits: int = 2, min_chars: int = 32) -> DataFrame:
    """(key, version, line_no, class, n_links) for every line that has company: an exact copy anywhere, or a line at most ``edits``
    edits away, directly or through others.

    ``class`` is the place (key, version, line_no) of the class's first line; ``n_links`` counts the distinct lines within ``edits``.
    Lines shorter than ``min_chars`` (more than ``edits + 1``) have exact copies only; blank ones of them are left out.  Null and
    empty texts have no lines.
    """
    if min_chars <= edits + 1:
        raise ValueError("lines must be longer than the number of segments")
    with Stages(df.sparkSession) as stages:
        keys = stages.cut(_lines(df, key, text, min_chars).select(*KEYED, "line_no", "id", "check"))
        links = near_links(df, key, text, edits, min_chars, stages)
        degree = (
            links.select(F.explode(F.array("src", "dst")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        )
        named = stages.cut(
            connected_components(links).join(dealt(degree), "node").select("node.id", "node.check", "component", "n_links")
        )
        # Equal rows of the input are one document: their lines count once.
        counted = keys.groupBy("id", "check").agg(F.min(_place()).alias("first"), F.max(_place()).alias("last"))
        placed = dealt(counted).join(named, ["id", "check"], "left").filter("first <> last OR component IS NOT NULL")
        placed = stages.cut(placed)
        lowest = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("class"))
        company = (
            dealt(placed).join(lowest, "component", "left")
            .select("id", "check", F.coalesce("class", "first").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
        )
        return cut_lineage(
            dealt(keys).join(company, ["id", "check"]).select("key", "version", "line_no", "class", "n_links").distinct()
        )


def dropped_lines(classes: DataFrame) -> DataFrame:
    """(key, version, dropped): numbers of the lines that are not the first of their class; an array a document can hold."""
    return (
        classes.filter(F.col("class") != _place())
        .groupBy(*KEYED).agg(F.sort_array(F.collect_set("line_no")).alias("dropped"))
    )


def dedup_lines(
    df: DataFrame, key: str, text: str, edits: int = 2, min_chars: int = 32, shortest: int | None = None
) -> DataFrame:
    """The rows of ``df`` with every line but the first of its class taken out of the text.

    Lines under ``shortest`` characters (``min_chars`` if not given) stay where they are; with 1 every copy goes.
    First is by key, then by text version, then by line number.  Rows of which nothing is left go; rows that were empty or null before
    stay as they are.  Equal rows are one document and get equal texts.  Other columns are untouched.
    """
    dropped = dropped_lines(line_classes(df, key, text, edits, min_chars)).select(
        F.col("key").alias("__key"), F.col("version").alias("__version"), F.col("dropped").alias("__dropped")
    )
    body, least = F.col(f"`{text}`"), min_chars if shortest is None else shortest
    joined = df.withColumn("__of", F.xxhash64(body)).join(
        dealt(dropped), F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("__of") == F.col("__version")), "left"
    )
    kept = F.array_join(
        F.filter(
            F.split(body, "\n"), lambda line, i: (F.length(line) < least) | ~F.array_contains(F.col("__dropped"), i)
        ), "\n"
    )
    changed = F.col("__dropped").isNotNull() & (kept != body)
    return (
        joined.withColumn("__changed", changed).withColumn(text, F.when(F.col("__changed"), kept).otherwise(body))
        .filter(~F.coalesce("__changed", F.lit(False)) | _written(body))
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )
