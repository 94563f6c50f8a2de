"""Fingerprints, links and components against brute force; line dedup against all pairs of lines."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strainwise import session
from strainwise.llm import components, line_dedup, simhash
from strainwise.llm.components import connected_components


def brute_fingerprint(text, words):
    found = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def documents(seed=5):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "Γάμμα", "delta", "É", "zeta", "eta", "theta"]
    base = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 80))) for _ in range(30)]
    texts = []
    for _ in range(150):
        parts = draw.choice(base).split(" ")
        for _ in range(draw.randint(0, 2)):
            parts[draw.randrange(len(parts))] = draw.choice(words)
        texts.append(draw.choice([" ", "  ", "\n"]).join(parts))
    return [(i, t, "x") for i, t in enumerate(texts)] + [(500, None, "y"), (501, "", "y"), (502, " \n\t", "y"), (3, texts[3], "z")]


@pytest.mark.parametrize("longest_list", [256, 2])
def test_simhash_components(spark, longest_list):
    """With lists cut to two, crowded neighbourhoods are linked by midpoints and must give the same components."""
    rows = documents() if longest_list > 2 else documents()[:40] + documents()[-4:]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = simhash.near_duplicates(df, "doc_id", "text", words=4, longest_list=longest_list).collect()
    prints = [(i, brute_fingerprint(t, 4)) for i, t, _ in rows]
    linked = [(a, b) for (a, x), (b, y) in itertools.combinations(prints, 2) if bin(x ^ y).count("1") <= 4]
    wanted = brute_components({i for i, _, _ in rows}, linked)
    assert sorted((r["key"], r["fp"] % 2**64, r["component"]) for r in out) == sorted((i, p, wanted[i]) for i, p in prints)


def test_every_agreement_meets_a_list():
    for agree in (3, 4, 5):
        triples = [set(t) for t in simhash.covering(8, agree)]
        assert all(any(t <= set(q) for t in triples) for q in itertools.combinations(range(8), agree))
    assert len(simhash.covering(8, 4)) == 20


def test_one_of_each_group_stays(spark):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(3000)]
    groups = [[draw.choice(words) for _ in range(300)] for _ in range(12)]
    rows = []
    for g, body in enumerate(groups):
        for copy in range(6):
            text = list(body)
            for _ in range(copy % 3):
                text[draw.randrange(300)] = "changed"
            rows.append((10 * g + copy, " ".join(text), None))
    rows += [(900, None, "a"), (901, "", "b"), (None, "only here " + " ".join(words[:90]), "c"), (0, rows[0][1], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = simhash.keep_one_of_each(df, "doc_id", "text").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept) == sorted(
        [(False, 10 * g) for g in range(12)] + [(False, 900), (True, None)]
    )


def shingles_of(text):
    found = (text or "").lower().split()
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def looking_alike():
    """Copies with a few changed words, at similarities around four fifths, and texts that share a passage only."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    passage = [draw.choice(words) for _ in range(60)]
    texts = []
    for n in (1, 4, 5, 6, 9, 30, 90, 150, 400):
        for _ in range(4):
            body = [draw.choice(words) for _ in range(n)]
            texts.append(body)
            for changes in sorted({1, n // 60, n // 50, n // 45, n // 40, n // 25}):
                copy = list(body)
                for _ in range(changes):
                    copy[draw.randrange(n)] = draw.choice(words)
                texts.append(copy)
            texts.append(body + [draw.choice(words) for _ in range(n // 4)])
    texts += [passage + [draw.choice(words) for _ in range(draw.randint(5, 40))] for _ in range(40)]
    texts += [texts[30] * 3, passage * 4]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_similar_documents_are_those_of_all_pairs(spark):
    """Nothing is linked that no chain of similar pairs links, and nine tenths of the similar pairs are together."""
    rows = looking_alike()
    sets = [(i, shingles_of(t)) for i, t in rows]
    linked = [(a, b) for (a, x), (b, y) in itertools.combinations(sets, 2) if alike(x, y)]
    wanted = brute_components([i for i, _ in rows], linked)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.similar_documents(df, "doc_id", "text").collect()
    found = {r["key"]: r["component"]["key"] for r in out}
    assert len(out) == len(rows)
    assert all(wanted[i] == wanted[c] for i, c in found.items())
    assert np.mean([found[a] == found[b] for a, b in linked]) >= 0.9


@pytest.mark.parametrize("similarity", [0.80, 0.85, 0.90])
def test_recall_of_candidates(spark, similarity):
    """Pairs of 200 shingles made to share just as many as the similarity asks, among 600 unrelated texts."""
    draw = random.Random(int(100 * similarity))
    rows, n = [], 200
    differ = int(n * (1 - similarity) / (1 + similarity))
    for pair in range(150):
        body = [f"{pair}w{draw.randrange(10**6)}" for _ in range(n + 4)]
        # Words changed at the end take one shingle each.
        other = body[:n + 4 - differ] + [f"x{draw.randrange(10**6)}" for _ in range(differ)]
        rows += [(2 * pair, " ".join(body)), (2 * pair + 1, " ".join(other))]
        a, b = shingles_of(rows[-2][1]), shingles_of(rows[-1][1])
        assert len(a & b) / len(a | b) == pytest.approx(similarity, abs=0.01)
    rows += [(1000 + i, " ".join(f"u{draw.randrange(10**6)}" for _ in range(150))) for i in range(600)]
    found = {r["key"]: r["component"]["key"] for r in simhash.similar_documents(
        spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    same = [shingles_of(rows[2 * p][1]) for p in range(150)], [shingles_of(rows[2 * p + 1][1]) for p in range(150)]
    real = [p for p in range(150) if alike(same[0][p], same[1][p])]
    assert len(real) == 150 and np.mean([found[2 * p] == found[2 * p + 1] for p in real]) >= 0.9
    assert all(found[i] == i for i in found if i >= 1000)


def test_unrelated_texts_meet_in_no_list(spark):
    """However many there are: lists by bytes alone make their number of chance meetings grow with its square."""
    draw = random.Random(11)
    rows = [(i, " ".join(f"u{draw.randrange(10**6)}" for _ in range(30))) for i in range(4000)]
    rows += [(4000 + i, rows[i][1] + " more") for i in range(20)]
    prints = spark.createDataFrame(rows, "num long, text string").select("num", simhash.wide_prints(F.col("text")).alias("s")).select("num", "s.*")
    met = simhash._wide_postings(prints).groupBy("list").agg(F.collect_set(F.col("num") % 4000).alias("who"), F.count("*").alias("many"))
    found = met.filter("many > 1").collect()
    assert all(len(r["who"]) == 1 for r in found)
    assert {r["who"][0] for r in found} == set(range(20))


def test_a_crowd_of_near_copies_and_long_texts(spark):
    """A third of the rows alike, each with a change of its own; one text of a hundred thousand words."""
    draw = random.Random(3)
    body = [f"w{draw.randrange(5000)}" for _ in range(300)]
    crowd = []
    for i in range(150):
        text = list(body)
        text[draw.randrange(300)] = f"own{i}"
        crowd.append((i, " ".join(text)))
    rest = [(1000 + i, " ".join(f"r{draw.randrange(9999)}" for _ in range(80))) for i in range(300)]
    long = " ".join(f"l{draw.randrange(999)}" for _ in range(100_000))
    df = spark.createDataFrame(crowd + rest + [(5000, long), (5001, long + " more")], "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in simhash.keep_one_of_each(df, "doc_id", "text").collect())
    assert kept == [0, *range(1000, 1300), 5000]


def test_near_duplicates_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df, "doc_id", "text").count() == 0
    assert simhash.keep_one_of_each(df, "doc_id", "text").count() == 0
    assert line_dedup.dedup_lines(df, "doc_id", "text").count() == 0


def test_components(spark):
    draw = random.Random(9)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    out = connected_components(spark.createDataFrame(links, "src long, dst long")).collect()
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {(r["node"], r["component"]) for r in out} == set(brute_components(nodes, links).items())


def test_components_of_a_task_need_no_round(spark, monkeypatch):
    """The links that one task reads are joined there, whatever the chain; nodes are numbers or structs of them."""
    rounds = []
    monkeypatch.setattr(components, "_large_star", lambda edges, step=components._large_star: rounds.append(1) or step(edges))
    order = random.Random(3).sample(range(300), 300)
    chain = spark.createDataFrame([(a, b) for a, b in zip(order, order[1:])], "src long, dst long").coalesce(1)
    kept = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert {tuple(r) for r in connected_components(chain).collect()} == {(n, 0) for n in range(300)}
        pair = "struct({0} - 150 AS a, {0} AS b) AS {0}"
        pairs = connected_components(chain.selectExpr(pair.format("src"), pair.format("dst"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum") if kept is None else spark.conf.set("spark.sql.files.minPartitionNum", kept)
    assert {(r.node.a, r.node.b, r.component.a, r.component.b) for r in pairs} == {(n - 150, n, -150, 0) for n in range(300)}
    assert len(rounds) == 0


def test_components_over_many_tasks(spark, monkeypatch):
    """Small chunks leave the joining to the rounds; a node with many links, chains and names that are no numbers."""
    monkeypatch.setattr(components, "CHUNK", 7)
    rng = random.Random(8)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(500, 500 + i) for i in range(1, 90)]
    of = brute_components(sorted({n for pair in links for n in pair}), links)
    wanted = {n: of[n] for pair in links if pair[0] != pair[1] for n in pair}
    table = spark.createDataFrame(links, "src long, dst long").repartition(8)
    assert {r.node: r.component for r in connected_components(table).collect()} == wanted
    named = table.selectExpr("format_string('%03d', src) AS src", "format_string('%03d', dst) AS dst")
    assert {int(r.node): int(r.component) for r in connected_components(named).collect()} == wanted


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        last = row
    return last[-1]


def line_documents():
    draw = random.Random(3)
    base = ["".join(draw.choice("abcé ") for _ in range(draw.randint(8, 50))) for _ in range(25)]

    def changed(line):
        out = list(line)
        for _ in range(draw.randint(0, 4)):
            at, kind = draw.randrange(len(out) + 1), draw.random()
            if kind < 0.33:
                out[at:at + 1] = []
            elif kind < 0.66:
                out.insert(at, draw.choice("abcé "))
            else:
                out[at:at + 1] = [draw.choice("abcé ")]
        return "".join(out)

    rows = [(i, "\n".join(changed(draw.choice(base)) for _ in range(draw.randint(0, 6)))) for i in range(80)]
    return rows + [(5, rows[5][1]), (None, rows[7][1]), (200, None), (201, ""), (5, "other\n" + base[0])]


def brute_dedup(rows, edits, min_chars):
    """Kept texts by row, from all pairs of distinct lines; the order of versions of one key is Spark's hash."""
    places = {}
    for key, version, text in rows:
        for number, line in enumerate((text or "").split("\n") if text is not None else []):
            if len(line) >= min_chars:
                place = (key is not None, key or 0, version, number)
                places.setdefault(line, []).append(place)
    first = {line: min(p) for line, p in places.items()}
    near = [
        (first[a], first[b]) for a, b in itertools.combinations(places, 2)
        if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits
    ]
    top = brute_components(set(first.values()), near)
    out = []
    for key, version, text in rows:
        if text is None:
            out.append((key, None))
            continue
        lines = text.split("\n")
        kept = [
            line for number, line in enumerate(lines)
            if len(line) < min_chars or top[first[line]] == (key is not None, key or 0, version, number)
        ]
        if len(kept) == len(lines) or "".join(kept).strip():
            out.append((key, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_dedup_is_that_of_all_pairs(spark, edits):
    rows = line_documents()
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, version int")
    versions = [
        (r["doc_id"], r["v"], r["text"]) for r in df.withColumn("v", F.xxhash64("text")).collect()
    ]
    out = line_dedup.dedup_lines(df, "doc_id", "text", edits, 8)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == brute_dedup(versions, edits, 8)


def test_edit_distance_of_pairs(spark):
    draw = random.Random(4)
    pairs = []
    for _ in range(600):
        a = "".join(draw.choice("ab") for _ in range(draw.randint(0, 60)))
        b = list(a)
        for _ in range(draw.randint(0, 4)):
            at = draw.randrange(len(b) + 1)
            b[at:at + draw.randint(0, 1)] = draw.choice(["", "a", "b"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        near = df.filter(F.abs(F.length("a") - F.length("b")) <= edits)
        out = near.withColumn("near", line_dedup.edit_distance_within(F.col("a"), F.col("b"), edits)).collect()
        assert all(r["near"] == (distance(r["a"], r["b"]) <= edits) for r in out)


def test_copies_of_short_lines(spark):
    notice = "All rights reserved."
    rows = [(1, f"one\n{notice}\n\n  "), (2, f"{notice}\n\ntwo\n  "), (3, notice), (4, "All rights reserved!\n\n  "), (None, "一\n二"), (5, "二")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.line_classes(df, "doc_id", "text").collect()
    assert {(r["key"], r["line_no"], r["class"]["key"], r["class"]["line_no"], r["n_links"]) for r in found} == {
        (1, 1, 1, 1, 0), (2, 0, 1, 1, 0), (3, 0, 1, 1, 0), (None, 1, None, 1, 0), (5, 0, None, 1, 0)
    }
    kept = line_dedup.dedup_lines(df, "doc_id", "text", shortest=1).collect()
    assert {(r["doc_id"], r["text"]) for r in kept} == {(1, rows[0][1]), (2, "\ntwo\n  "), (4, rows[3][1]), (None, rows[4][1])}
    assert line_dedup.dedup_lines(df, "doc_id", "text").count() == len(rows)


def test_too_short_lines_are_refused(spark):
    with pytest.raises(ValueError):
        line_dedup.line_classes(spark.createDataFrame([], "k long, t string"), "k", "t", 2, 3)


def test_tables_that_grow_are_never_broadcast(frame, monkeypatch):
    """Sizes guessed from files say little of lists, sets and texts: below Spark's default bound the index of 0.5 GB of documents was sent to
    the driver.  Nor are the lists made twice, once to look for empty ones."""
    texts = [f"line {i} of a text that goes on for a while\n" + " ".join(f"w{(i // 2 * 31 + j) % 977}" for j in range(60)) for i in range(12)]
    docs = frame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return df

    class Noting(session.Stages):
        def cut(self, df):
            return super().cut(noted(df))

    for module in (simhash, line_dedup):
        monkeypatch.setattr(module, "Stages", Noting)
        monkeypatch.setattr(module, "cut_lineage", lambda df: session.cut_lineage(noted(df)))
    noted(simhash.keep_one_of_each(docs, "doc_id", "text"))
    lists = [p for p in plans if "lists(" in p]
    assert lists and all("size(" not in p for p in lists)
    noted(line_dedup.dedup_lines(docs, "doc_id", "text"))
    assert sum("SortMergeJoin" in p for p in plans) > 8
    assert not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p]
