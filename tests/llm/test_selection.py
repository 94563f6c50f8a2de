"""Toxicity, URL rules, chat formatting, mixing, top-k search, quality rules and the pipeline against plain Python."""

import hashlib
import itertools
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strainwise.llm import chat, mixing, quality, queries, topk, toxicity
from strainwise.llm.url_filter import Rule, build_cascade, judge_urls, listed

SMALL = "/root/testdata/sf0.001"


# Toxicity


def corpus(n, seed):
    draw = random.Random(seed)
    clean = ["".join(draw.choice("aeiou") + draw.choice("bdfgklmnprst") for _ in range(draw.randint(1, 4))) for _ in range(400)]
    bad = ["xyzzyqu" + s for s in ("", "a", "ed", "ing", "or", "wx")]
    rows = []
    for i in range(n):
        words = [draw.choice(clean) for _ in range(draw.randint(30, 120))]
        toxic = i % 5 == 0
        for _ in range(len(words) // 25 + 1 if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(800, 1)
    return toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows])


def test_unseen_texts_and_misspellings(model):
    rows = corpus(300, 2)
    score = toxicity.Scorer(model).score([t for _, t, _ in rows])
    right = (score >= 0.5) == np.array([y == 1 for _, _, y in rows])
    assert right.mean() > 0.95
    plain, misspelt = toxicity.Scorer(model).score(["gader " * 20, "gader " * 20 + "xyzzyquzzle"])
    assert misspelt > plain


def test_score_is_the_mean_of_subwords(model):
    text = "Gader, modi! xyzzyqu (gader) É"
    rows, owners = toxicity.Subwords(model.settings).rows(toxicity.words_of(text))
    logit = model.logits[rows].astype(float).mean() + model.bias
    assert toxicity.Scorer(model).score([text])[0] == pytest.approx(1 / (1 + math.exp(-logit)), rel=1e-6)
    assert len(owners) == len(rows)


def test_words_of_few_toxic_rows_are_learned():
    """Twelve toxic rows of 1,500: their words stand in fewer than one row of 300 of all."""
    rows = [(t, 0) for _, t, y in corpus(1900, 4) if not y][:1488]
    draw = random.Random(5)
    for i in range(12):
        words = rows[draw.randrange(1400)][0].split()
        for word in ["vexqua", "wyzzor", "jhuxxi"][i % 3:i % 3 + 1] * (len(words) // 12):
            words.insert(draw.randrange(len(words)), word)
        rows.append((" ".join(words), 1))
    fitted = toxicity.fit([t for t, _ in rows], [y for _, y in rows])
    found, _ = toxicity.Subwords(fitted.settings).rows([b"vexqua", b"wyzzor", b"jhuxxi"])
    assert (fitted.logits[found[:3]] > 0).all()  # the words as a whole, each in four documents


def test_fitting_little():
    assert toxicity.Scorer(toxicity.fit([], [])).score(["x", ""]).tolist() == [0.5, 0.5]
    only = toxicity.fit(["some words"] * 3, [0] * 3)
    assert (toxicity.Scorer(only).score(["some words", ""]) < 0.5).all()


def test_labels_of_held_out_rows_are_never_read(spark):
    docs = [(i, f"text number {i}", 0) for i in range(60)] + [(None, "no key", 0), (3, None, 0)]
    labels = [(i, 0 if zlib.crc32(str(i).encode()) % 5 else 1) for i in range(60)] + [(None, 1), (7, 1), (8, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, label int")
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    fitted = toxicity.learn(df, given, "doc_id", "text", "toxic")
    out = toxicity.score_toxicity(df, "text", fitted).withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    assert len(out) == len(docs) and all(0 <= r["score"] < 0.5 and r["predicted"] == 0 for r in out)  # no toxic label was seen
    assert all(r["held"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)


def test_held_out_rows_do_not_change_the_model(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(80, 3)], "doc_id long, text string")
    rows = [(i, y) for i, _, y in corpus(80, 3)]
    turned = [(i, y if zlib.crc32(str(i).encode()) % 5 else 1 - y) for i, y in rows]
    one, other = (
        toxicity.learn(docs, spark.createDataFrame(r, "doc_id long, toxic int"), "doc_id", "text", "toxic") for r in (rows, turned)
    )
    assert (one.logits == other.logits).all() and one.bias == other.bias


def test_toxicity_is_fitted_in_a_task(spark, monkeypatch):
    """The driver's process neither holds the sample nor fits; the rows come in order of their keys, also if there are none."""
    seen = lambda texts, labels, settings: toxicity.Model(settings, np.float32([len(texts), *labels]), float(os.getpid()))
    monkeypatch.setattr(toxicity, "fit", seen)
    docs = spark.createDataFrame([(i, t) for i, t, _ in corpus(80, 3)], "doc_id long, text string").repartition(7)
    rows = [(i, y) for i, _, y in corpus(80, 3)]
    kept = [y for i, y in rows if zlib.crc32(str(i).encode()) % 5]
    found = toxicity.learn(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), "doc_id", "text", "toxic")
    assert found.bias != os.getpid() and found.logits.tolist() == [len(kept), *kept]
    assert toxicity.learn(docs.limit(0), spark.createDataFrame(rows, "doc_id long, toxic int"), "doc_id", "text", "toxic").logits.tolist() == [0]


# URL rules

URLS = [
    None, "", "no scheme", "http://", "http://com", "http://com/", "http://COM/x?y=/z", "https://a.B.Example.com/en/1", "http://example.com/en/",
    "http://example.com/enx", "http://www.example.com/en/x#top", "http://m.www.example.com/en/", "http://xexample.com/en/", "x://net/es/?q",
    "x://a.net?/es/", "x://a.net/fr/1", "x://a.net/FR/1", "x://://net/es/", "x://org/en/", "x://example.com.org/en/", "x://.com/", "x://a..com/",
    "x://net/es/\nb", "x://" + "a." * 3000 + "com/",
]


def brute_verdict(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest[: min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])]
    path = rest[len(host):]
    path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fitting, key=lambda r: (-len(r.text), r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def test_rules_on_odd_urls(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string")
    out = judge_urls(df, "url", queries.RULES).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in out] == [brute_verdict(u, queries.RULES) for u in [*URLS, *URLS]]


def test_no_rules_and_no_rows(spark):
    df = spark.createDataFrame([(1, URLS[6])], "page_id long, url string")
    assert [r["verdict"] for r in judge_urls(df, "url", []).collect()] == ["allow"]
    assert judge_urls(df.limit(0), "url", queries.RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(df, "url", [Rule("allow", "a", "/"), Rule("block", "a", "/")])


def test_cascade_is_exact_for_every_key(spark):
    keys = [f"host{i}.net/p{i % 7}/" for i in range(4000)]
    chosen = keys[::37]
    df = spark.createDataFrame([(k,) for k in [*keys, *keys[:100], None]], "key string")
    levels = build_cascade(df, chosen)
    assert len(levels) > 1  # false positives did occur and were encoded
    found = {r["key"] for r in df.filter(listed(F.col("key"), levels)).collect()}
    assert found == set(chosen)


# Chat


def brute_chat(rows):
    out = {}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for conv, group in itertools.groupby(ordered, key=lambda r: r[0]):
        turns = [(role or "", text or "") for _, _, role, text in group]
        out[conv] = (turns, "".join(t for r, t in turns if r == "assistant"))
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>\\<|im_start|>assistant\\|ok\\\\<|"), (1, 2, "assistant", "again"),
    (2, 5, "assistant", ""), (2, 5, "assistant", ""), (2, None, "system", None), (3, 1, None, "x<"), (3, 2, "we|ird\n<|im_sep|>", "🙂|>"),
    (None, 1, "user", "a"), (None, 2, "assistant", "b" * 5000), (4, 0, "assistant ", "not learned"),
]


def test_chat_reads_back(spark):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, start int")
    out = chat.format_paths(chat.linear_replies(df, "conv_id", "turn", "role", "text")).select(
        "conv", "branch", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("learned"),
    ).collect()
    assert {r["conv"]: ([tuple(t) for t in r["turns"]], r["learned"]) for r in out} == brute_chat(ROWS)
    for r in out:
        assert r["formatted"].count("<|im_start|>") == len(r["turns"]) == r["formatted"].count("<|im_end|>")


def test_best_branches_of_a_tree(spark):
    rows = [
        (1, 1, None, 1.0), (1, 2, 1, 5.0), (1, 3, 1, 1.0), (1, 4, 2, 0.0), (1, 5, 3, 9.0), (1, 6, 5, 0.0), (1, 7, 99, 2.0),
        (None, 1, None, None), (2, 1, None, 0.0), (2, 2, 1, 0.0), (2, 3, 1, 0.0),
    ]
    df = spark.createDataFrame([(*r[:3], "user", f"m{r[1]}", r[3]) for r in rows], "conv long, node long, parent long, role string, text string, score double")
    found = defaultdict(list)
    for r in chat.best_paths(df, branches=2).orderBy("place").collect():
        found[r["conv"], r["branch"]].append(r["node"])
    # Means: 1-2-4: 2.0, 1-3-5-6: 2.75, 7: 2.0 (shorter).
    assert found == {(1, 1): [1, 3, 5, 6], (1, 2): [1, 2, 4], (None, 1): [1], (2, 1): [1, 2], (2, 2): [1, 3]}


def test_long_chain_and_circle(spark):
    chain = spark.createDataFrame([(1, i, "user", f"t{i}") for i in range(150)], "c long, t long, r string, x string")
    out = chat.format_paths(chat.linear_replies(chain, "c", "t", "r", "x")).first()
    assert out["formatted"].count("<|im_start|>") == 150 and out["loss"] == []
    circle = spark.createDataFrame([(1, 1, 2, "u", "x", 0.0), (1, 2, 1, "u", "y", 0.0)], "conv long, node long, parent long, role string, text string, score double")
    with pytest.raises(ValueError):
        chat.best_paths(circle)
    assert chat.format_paths(chat.linear_replies(chain.limit(0), "c", "t", "r", "x")).count() == 0


# Mixing


def mix_rows():
    draw = random.Random(6)
    rows = [
        (i, " \n".join(["w"] * draw.choice([1, 3, 50, 400, 3000])), draw.choice(["a", "b", "b", "b", "Z", "é", None]), "x") for i in range(400)
    ]
    return rows + [(1000, None, "a", "x"), (1001, "", "b", "x"), (1002, "w", "alone", "x"), (5, rows[5][1], rows[5][2], "x"), (None, "w w", None, "x")]


def brute_targets(sizes, weights, share, limit):
    names = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out = {s: 0.0 for s in names}
    free, left = set(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            out[s] += left * weight[s] / total
        left = sum(max(0, out[s] - limit * sizes[s]) for s in names)
        out = {s: min(out[s], limit * sizes[s]) for s in names}
        free = {s for s in names if out[s] < limit * sizes[s] - 1e-9}
    return out


def test_mix_meets_targets(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    recipe = mixing.Recipe(shards=5)
    out = mixing.mix(df, "doc_id", "text", "source", recipe).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    wanted = brute_targets(sizes, (3, 1, 2), 1.5, 2)
    taken, blocks = Counter(), Counter()
    for r in out:
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        for p in r["pieces"]:
            assert 0 <= p["first_word"] and p["first_word"] + p["n_words"] <= r["size"] and 0 <= p["shard"] < 5
            taken[r["source"]] += p["n_words"]
            blocks[r["source"], p["pass"], p["block"]] += p["n_words"]
        assert sum(p["n_words"] for p in r["pieces"]) <= 2 * r["size"]
    assert all(abs(taken[s] - wanted[s]) <= 2 * recipe.block_words for s in sizes)
    assert max(blocks.values()) <= recipe.block_words  # every block is dealt once a pass
    again = mixing.mix(df.repartition(7), "doc_id", "text", "source", recipe).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))


def test_small_sources_come_near_their_targets(spark):
    sizes = [100] * 60 + [1, 2, 63, 65, 127, 700, 5000]
    df = spark.createDataFrame([(i, "w " * n, f"s{i:03}") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    out = mixing.mix(df, "doc_id", "text", "source").select("source_size", "target", mixing.taken_words(F.col("pieces")).alias("n")).collect()
    assert len(out) == len(sizes)
    assert all(abs(r["n"] - r["target"]) <= max(1, 2 * r["source_size"] / 64) for r in out)
    assert abs(sum(r["n"] - r["target"] for r in out)) <= 0.02 * sum(r["target"] for r in out)


def test_shards_hold_exact_quotas():
    split = mixing.split_quotas([1000, 1, 0, 77], 13, 3)
    assert split.sum(axis=1).tolist() == [1000, 1, 0, 77]
    assert set(split.sum(axis=0).tolist()) <= {1078 // 13, 1078 // 13 + 1}
    assert (split == mixing.split_quotas([1000, 1, 0, 77], 13, 3)).all()


def test_drawn_documents_hold_the_words_taken(spark):
    rows = [(i, f"a{i}  b\n" + " ".join(f"w{k}" for k in range(40 * i)), "s" if i % 3 else "t", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    mixed = mixing.mix(df, "doc_id", "text", "source")
    drawn = Counter()
    for r in mixing.drawn_documents(mixed, "text", df.columns).collect():
        drawn[r["doc_id"]] += len(r["text"].split())
    assert drawn == Counter({r["doc_id"]: n for r in mixed.select("doc_id", mixing.taken_words(F.col("pieces")).alias("n")).collect() if (n := r["n"])})
    dealt = [r["piece"] for r in mixing.shard_order(mixed).collect()]
    assert sum(p["n_words"] for p in dealt) == sum(drawn.values())
    assert mixing.mix(df.limit(0), "doc_id", "text", "source").count() == 0


# Top k


@pytest.mark.parametrize("scale", [1, 10**6])
def test_top_k_is_exact(spark, monkeypatch, scale):
    for name, value in (("BLOCK_ROWS", 16), ("QUERY_ROWS", 8), ("CELL_ROWS", 3), ("BLOCKS_IN_TURN", 2), ("STEP", 2)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in scale * draw.normal(size=6).round(1)], "x") for i in range(150)]
    rows += [(200 + i, rows[0][1], "x") for i in range(30)]
    rows += [(300, None, "x"), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0], "x"), (340, [float("nan")] * 6, "x"), (360, [float("inf")] * 6, "x"), (None, rows[3][1], "x")]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, rank string")
    vectors = {i: [math.floor(64 * x) for x in v] for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    wanted = []
    for q in (i for i in vectors if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:7]
        wanted += [(q, at + 1, i, -score) for at, (score, i) in enumerate(best)]
    out = topk.top_k(df, "vec_id", topk.quantise(F.col("v")), F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted(map(tuple, out)) == sorted(wanted)


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, v array<double>")
    assert [tuple(r) for r in topk.top_k(df, "vec_id", topk.quantise(F.col("v")), F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 64 * 128)]
    assert topk.top_k(df.limit(0), "vec_id", topk.quantise(F.col("v")), F.lit(True), 5).count() == 0


# Quality


def brute_counts(text):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if line.strip("\t\n\x0b\x0c\r ")]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_counts():
    draw = random.Random(8)
    texts = ["".join(draw.choice("ab  é\n#\x0b\t\u00a0$") for _ in range(draw.randint(0, 200))) for _ in range(200)]
    for text in [None, "", " \n ", "a a a a", "a b c a b c", "é é é é é", *texts]:
        assert quality.counts_of(text) == brute_counts(text)


def test_small_groups_use_merged_sketches(spark):
    good = " ".join(f"word{i}" for i in range(60))
    bad = " ".join(f"word{i} ##$$%%&&||" for i in range(60))
    rows = [(i, "en", "big", good) for i in range(80)] + [(100, "en", "tiny", good), (101, "en", "tiny", bad), (102, None, None, good)]
    rows += [(103, "xx", "tiny", bad), (104, "en", "big", bad), (105, "en", "big", ""), (106, "en", "big", None), (100, "en", "tiny", good)]
    df = spark.createDataFrame([(*r, False) for r in rows], "doc_id long, lang string, source string, text string, kept boolean")
    measured = quality.measure(df.drop("kept"), "text")
    out = quality.judge(measured, quality.fences(measured, ["lang", "source"]), ["lang", "source"]).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"] for r in out if not r["kept"]} == {101, 103, 104, 105, 106}
    empty = measured.limit(0)
    assert quality.judge(empty, quality.fences(empty, ["lang", "source"]), ["lang", "source"]).count() == 0


# Queries and pipeline


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_oracles(spark, name):
    from tools.check_queries import compare, connect

    frame = queries.QUERIES[name](spark, SMALL)
    cursor = connect(SMALL).execute(queries.ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert compare(frame.columns, [tuple(r) for r in frame.collect()], columns, cursor.fetchall()) == "ok"


def test_contract_columns(spark):
    wanted = {
        "op2_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op6_simhash": ["doc_id", "fingerprint", "component_id"],
        "op8_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    }
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name, columns in wanted.items():
        out = queries.QUERIES[name](spark, SMALL)
        assert out.columns == columns and out.count() == n


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, None, None, None), (None, "", "en", "src1", 0)], docs.schema)
    docs = docs.union(extra)
    seen = [docs.count()]
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SMALL).cache()
        seen.append(docs.count())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert docs.columns == columns
    assert 0 < seen[3] < seen[0] and seen[4] == seen[5]
    vocabulary = queries.load_vocabulary(queries.public_tokenizers.path(queries.BYTE_RANKS))
    for row in docs.collect():
        text = b"".join(vocabulary.pieces[i] for i in row["ids"])
        assert hashlib.sha256(text).hexdigest() == row["decoded_sha256"]
        assert len(text.decode()) == (row["n_chars"] or 0)
