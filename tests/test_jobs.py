import json
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from conftest import rows
from strainwise.operators import browser, genes, ingest, lineage, matrix, qc, relational as rel, submissions, subspace
from strainwise.plans import intake, registry
from strainwise.plans.derived import Inputs
from strainwise.session import work_area
from strainwise.sources import sinks, tables
from strainwise.streaming import incremental

SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ matrices
def numpy_scores(x, k):
    centred = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    return (u * s)[:, :k]


def test_components_agree_with_numpy(frame):
    random = np.random.default_rng(3)
    x = random.normal(size=(60, 12)) @ np.diag([9, 7, 5, 3] + [0.3] * 8)
    long = frame([(i, j, float(x[i, j])) for i in range(60) for j in range(12)], "sample_id int, column int, value double")
    samples = long.select("sample_id").distinct()
    expected = np.abs(numpy_scores(x, 3))
    # Text keys, as any other.
    wide = frame([(f"s{i:02}", [float(v) for v in x[i]]) for i in range(60)], "name string, v array<double>")
    for result, key in ((matrix.center_pca(wide, "name", "v", 3), "name"), (matrix.subspace_pca(long, samples, 3), "sample_id")):
        found = np.abs(np.array([[r.pc1, r.pc2, r.pc3] for r in result.orderBy(key).collect()]))
        assert np.allclose(found, expected, atol=1e-4)


def test_unsettled_components_are_refused(frame):
    random = np.random.default_rng(4)
    long = frame([(i, j, float(random.normal())) for i in range(30) for j in range(25)], "sample_id int, column int, value double")
    with pytest.raises(ArithmeticError):
        matrix.subspace_pca(long, long.select("sample_id").distinct(), 2, passes=1, tolerance=1e-12)


def test_close_variances_settle(frame):
    """A flat spectrum, repeated variances and columns without variance need no gap; fewer directions than asked score zero."""
    random = np.random.default_rng(6)
    turned = np.linalg.qr(random.normal(size=(40, 40)))[0]
    x = np.c_[turned[:, :6] * [5, 5, 5, 1.0000001, 1, 1], np.full(40, 7.0)]
    entries = frame([(i, j, float(x[i, j])) for i in range(40) for j in range(7)], "sample_id int, column int, value double")
    centred = x - x.mean(axis=0)
    found = matrix.subspace_pca(entries, entries.select("sample_id").distinct(), 9).orderBy("sample_id").collect()
    scores = np.array([r[1:] for r in found])
    assert np.allclose(scores @ scores.T, centred @ centred.T, atol=1e-6)
    assert np.allclose(scores[:, 6:], 0)
    assert np.all(np.diff((scores**2).sum(axis=0)) < 1e-6)


def test_components_of_many_columns_leave_no_stages(spark, frame):
    """More columns than one block spans; what was written on the way is gone."""
    import os

    random = np.random.default_rng(7)
    x = random.normal(size=(50, 120)) * np.r_[8, 6, 4, np.full(117, 1.0)]
    entries = frame([(i, j, float(x[i, j])) for i in range(50) for j in range(120)], "sample_id int, column int, value double")
    samples = entries.select("sample_id").distinct()
    matrix.subspace_pca(entries, samples, 2)
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    found = matrix.subspace_pca(entries, samples, 4).orderBy("sample_id").collect()
    assert len(set(os.listdir(root)) - before) == 1
    assert np.allclose(np.abs([r[1:] for r in found]), np.abs(numpy_scores(x, 4)), atol=1e-4)


def test_directions_kept_are_bounded(frame, monkeypatch):
    """Close variances take many passes; a pass writes no more directions than the one before, and the components stay those of numpy."""
    random = np.random.default_rng(8)
    x = random.choice([0.0, 1.0, -1.0], size=(150, 200), p=[0.9, 0.05, 0.05])
    held = []
    products = subspace._products
    monkeypatch.setattr(subspace, "_products", lambda columns, width, block: held.append(width) or products(columns, width, block))
    entries = frame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))], "sample_id int, column int, value double")
    samples = frame([(i,) for i in range(150)], "sample_id int")
    found = matrix.subspace_pca(entries, samples, 1).orderBy("sample_id").collect()
    assert np.allclose(np.abs([r[1:] for r in found]), np.abs(numpy_scores(x, 1)), atol=1e-4)
    assert len(held) > subspace.MOST_BLOCKS and max(held) <= subspace.MOST_BLOCKS * 5


def test_nothing_varies(frame):
    entries = frame([(i, 0, 2.0) for i in range(5)], "sample_id int, column int, value double")
    samples = entries.select("sample_id")
    assert {tuple(r[1:]) for r in matrix.subspace_pca(entries, samples, 2).collect()} == {(0.0, 0.0)}
    assert {tuple(r[1:]) for r in matrix.subspace_pca(entries.limit(0), samples, 2).collect()} == {(0.0, 0.0)}


def test_genotype_components_are_those_of_the_dense_matrix(frame):
    random = np.random.default_rng(5)
    calls, varying = [], []
    for site in range(8):
        varying += [(site * 2, site, 1, 3), (site * 2 + 1, site, 1, 4)]
        for sample in range(20):
            if random.random() < 0.3 + 0.05 * site:
                calls.append((sample, site * 2 + int(random.random() < 0.4), 0.9))
    calls = frame(calls, "sample_id int, variant_id int, dp double")
    varying = frame(varying, "variant_id int, position int, reference_int int, alternative_int int")
    samples = frame([(i,) for i in range(20)], "sample_id int")
    codes = matrix.genotype_matrix(calls, varying, samples).orderBy("sample_id").collect()
    expected = numpy_scores(np.array([r.codes for r in codes], float), 2)
    found = matrix.genotype_pca(calls, varying, samples, k=2).orderBy("sample_id").collect()
    assert np.allclose(np.abs([[r.pc1, r.pc2] for r in found]), np.abs(expected), atol=1e-3)


def test_sparse_rows_stand_for_the_dense_matrix(frame):
    """Places count positions in order across range partitions; a sample without differences has empty arrays; others' calls stay out."""
    varying = frame([(i, 1000 - 3 * i, 1 + i % 4, 1 + (i + 1) % 4) for i in range(200)],
                    "variant_id int, position int, reference_int int, alternative_int int")
    calls = frame([(1, 0, 0.9), (1, 199, 0.8), (1, 57, 0.9), (2, 100, 0.9), (9, 3, 0.9)], "sample_id int, variant_id int, dp double")
    samples = frame([(1,), (2,), (3,)], "sample_id int")
    reference, sparse = matrix.sparse_matrix(calls, varying, samples)
    row = [(r.place, r.position) for r in reference.orderBy("place").collect()]
    assert row == list(enumerate(sorted(1000 - 3 * i for i in range(200))))
    held = {r.sample_id: (r.places, r.codes) for r in sparse.collect()}
    assert held == {1: ([0, 142, 199], [1 + 200 % 4, 1 + 58 % 4, 2]), 2: ([99], [1 + 101 % 4]), 3: ([], [])}
    dense = matrix.dense_genotype_calls(calls, varying, samples).orderBy("position").collect()
    expected = {s: [r.integer for r in dense if r.sample_id == s] for s in (1, 2, 3)}
    assert {r.sample_id: r.codes for r in matrix.dense_rows(reference, sparse).collect()} == expected


def test_dense_calls_are_written_out_behind_the_last_join(frame):
    """Several blocks of positions give the rows of the matrix; the cells of the product are not exchanged, and are written in many tasks."""
    varying = frame([(i, 7 * i, 1 + i % 4, 1 + (i + 1) % 4) for i in range(2500)], "variant_id int, position int, reference_int int, alternative_int int")
    calls = frame([(1, i, 0.9) for i in (0, 1023, 1024, 2047, 2048, 2499)], "sample_id int, variant_id int, dp double")
    samples = frame([(1,), (2,)], "sample_id int")
    dense, whole = matrix.dense_genotype_calls(calls, varying, samples), matrix.genotype_matrix(calls, varying, samples)
    held = dense.orderBy("sample_id", "position").collect()
    assert [r.position for r in held] == 2 * [7 * i for i in range(2500)]
    assert [r.integer for r in held] == [c for r in whole.orderBy("sample_id").collect() for c in r.codes]
    plan = dense._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("Join")
    for frame_ in (dense, whole):
        assert "REPARTITION_BY_NUM" in frame_._jdf.queryExecution().executedPlan().toString()


def test_strongest_call_wins(frame):
    calls = frame([(1, 1, 0.8), (1, 2, 0.9)], "sample_id int, variant_id int, dp double")
    varying = frame([(1, 5, 1, 2), (2, 5, 1, 3), (3, 6, 4, 1)], "variant_id int, position int, reference_int int, alternative_int int")
    out = matrix.dense_genotype_calls(calls, varying, frame([(1,), (2,)], "sample_id int"))
    assert rows(out) == [(1, 5, 3), (1, 6, 4), (2, 5, 1), (2, 6, 4)]


def test_default_and_exceptions_expand_to_all_samples(frame):
    markers = frame([(1, 10, 7, False), (2, 20, 7, False), (3, 30, 8, True)], "variant_id int, position int, lineage_id int, count_presence boolean")
    calls = frame(
        [(1, 1, "bcftools", 25, 100), (1, 3, "bcftools", 40, 100), (2, 2, "bcftools", 100, 100), (5, 1, "other", 1, 1), (8, 1, "bcftools", 1, 2)],
        "sample_id int, variant_id int, genotyper string, alternative_ad int, total_dp int",
    )
    samples = frame([(1,), (2,), (5,)], "sample_id int")
    defaults, exceptions = lineage.marker_relation(markers, samples, calls)
    assert rows(defaults) == [(10, 7, 1.0), (20, 7, 1.0)]
    assert rows(exceptions) == [(1, 10, 7, True, 0.75), (1, 30, 8, False, 0.4), (2, 20, 7, True, 0.0)]
    assert rows(lineage.expand_defaults(defaults, exceptions, samples)) == [
        (1, 10, 7, 0.75), (1, 20, 7, 1.0), (1, 30, 8, 0.4), (2, 10, 7, 1.0), (2, 20, 7, 0.0), (5, 10, 7, 1.0), (5, 20, 7, 1.0),
    ]


# ------------------------------------------------------------------ generic
def test_exclude_intervals_across_bins(frame):
    points = frame([(p,) for p in range(0, 500)], "position int")
    spans = frame([(100, 260), (255, 300), (400, 400)], "start_pos int, end_pos int")
    out = {r.position for r in rel.exclude_intervals(points, spans, pad=5, width=16).collect()}
    assert out == {p for p in range(500) if not (95 <= p <= 305 or 395 <= p <= 405)}


def test_one_hot_group_gives_the_same_best_rows(spark):
    df = spark.range(20000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)).alias("k"), (F.col("id") % 11).alias("r"), "id")
    a = rel.best_ranked(df, ["k"], F.col("r")).select("id")
    b = rel.best_ranked_unbounded(df, ["k"], F.col("r")).select("id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_copies_of_a_product_are_not_broadcast(spark, frame):
    """The planner does not count the copies of the smaller side: it sent 256 times the reference row to the driver."""
    varying = frame([(i, 7 * i, 1, 2) for i in range(50)], "variant_id int, position int, reference_int int, alternative_int int")
    calls, samples = frame([(1, 3, 0.9)], "sample_id int, variant_id int, dp double"), frame([(1,), (2,)], "sample_id int")
    dense = matrix.dense_genotype_calls(calls, varying, samples)
    assert dense.count() == 100
    paired = rel.pair_all(samples, spark.range(3), "sample_id")
    for plan in (p._jdf.queryExecution().sparkPlan().toString() for p in (paired, dense)):
        assert "BroadcastHashJoin [_slot" not in plan and "SortMergeJoin [_slot" in plan
    assert paired.columns == ["sample_id", "id"]


def test_pair_all_is_complete(spark):
    out = rel.pair_all(spark.range(37).withColumnRenamed("id", "a"), spark.range(5).withColumnRenamed("id", "b"), "a")
    assert out.count() == 185 and out.distinct().count() == 185


def test_a_product_is_in_the_order_of_its_smaller_side(spark):
    """A row of the smaller side meets all rows of its slot in one run, so a file of the product holds its columns as runs."""
    out = rel.pair_all(spark.range(1500).withColumnRenamed("id", "a"), spark.range(4).withColumnRenamed("id", "b"), "a")
    slot = F.pmod(F.xxhash64("a"), F.lit(rel.PAIR_SLOTS))
    met = [tuple(r) for r in out.select(slot, "b").collect()]
    assert len(met) == 6000 and len([1 for x, y in zip([None, *met], met) if x != y]) == len(set(met))


def test_resolve_first_prefers_the_first_table(frame):
    df = frame([("x",), ("y",), ("z",)], "name string")
    first, second = frame([("x", 1)], "n string, i int"), frame([("x", 9), ("y", 2), ("y", 3)], "n string, i int")
    assert rows(rel.resolve_first(df, "name", [first, second], "id")) == [("x", 1), ("y", 2), ("z", None)]


# ------------------------------------------------------------------ tables
def test_upsert_keeps_old_values_where_new_are_missing(frame):
    old = frame([("a", 1, "x"), ("b", 2, None)], "k string, n int, t string")
    new = frame([("a", None, "y"), ("b", 5, None), ("c", None, None)], "k string, n int, t string")
    assert rows(sinks.upsert_coalesce(old, new, ["k"], ["n", "t"])) == [("a", 1, "y"), ("b", 5, None), ("c", None, None)]


def test_snapshots_read_their_own_table(spark):
    root = work_area(spark, "t")
    assert sinks.overwrite_truncate(spark.range(5), root) == 1
    assert sinks.overwrite_truncate(sinks.read_snapshot(spark, root).where("id > 2"), root) == 2
    assert rows(sinks.read_snapshot(spark, root)) == [(3,), (4,)]


def test_schema_assertion(frame):
    df = frame([(1, "a")], "i int, t string")
    assert sinks.assert_schema(df, {"i": IntegerType(), "t": StringType()}) is df
    with pytest.raises(ValueError, match="should be bigint"):
        sinks.assert_schema(df, {"i": LongType()})
    with pytest.raises(ValueError, match="missing required field x"):
        sinks.assert_schema(df, {"x": LongType()})


def test_status_moves_only_inside_the_batch(frame):
    df = frame([(1, "a", None), (2, "a", None), (3, "b", None)], "id int, bioanalysis_status string, bioanalysis_status_changed_at timestamp")
    out = sinks.transition_status(df, frame([(1,), (3,)], "id int"), "a", "z").orderBy("id").collect()
    assert [r.bioanalysis_status for r in out] == ["z", "a", "b"]
    assert [r.bioanalysis_status_changed_at is None for r in out] == [False, True, True]


# ------------------------------------------------------------------ ingestion
def test_deleted_bases_span_chunks(frame):
    genome = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(1, 301))
    sequence = frame([("c", genome)], "chromosome string, seq string")
    chunks = ingest.sequence_chunks(sequence, 16)
    staged = frame([("c", p, f"DEL-{p + n}", "A") for p, n in [(1, 5), (10, 40), (15, 2), (16, 1), (17, 200), (33, 16), (5, 300000)]],
                   "chromosome string, position int, reference_nucleotide string, alternative_nucleotide string")
    known = frame([(1, "c", 15, "GG", "A")], "variant_id int, chromosome string, position int, reference_nucleotide string, alternative_nucleotide string")
    out = {r.position: r.reference_nucleotide for r in ingest.register_deletions(staged, known, chunks, size=16).collect()}
    assert out == {p: genome[p - 1 : p - 1 + n] for p, n in [(1, 5), (10, 40), (16, 1), (17, 200), (33, 16)]}


def test_genomes_beyond_the_root_of_an_int(frame):
    """Squares of positions above 46340 exceed an int."""
    inputs = SimpleNamespace(part=frame([(3,), (47000,)], "p_partkey bigint"))
    chunks = {r.chunk: r.text for r in intake.genome_chunks(inputs, 64).collect()}
    whole = "".join(chunks[i] for i in range(len(chunks)))
    assert whole == "".join("ACGT"[(p * p + p // 3) % 4] for p in range(1, 47061))


def test_chunks_of_genomes_of_any_length(frame):
    whole = "".join("ACGT"[(p * p + p // 3) % 4] for p in range(1, 1061))
    sequence = frame([("c", whole), ("short", "A\nB"), ("empty", ""), ("none", None)], "chromosome string, seq string")
    cut = {(r.chromosome, r.chunk): r.text for r in ingest.sequence_chunks(sequence, 100).collect()}
    assert cut == {**{("c", i): whole[100 * i:100 * i + 100] for i in range(11)}, ("short", 0): "A\nB"}


def test_two_incremental_runs_equal_one(spark):
    t = Inputs(spark, SMALL)
    root = work_area(spark, "inc")
    orders = t.orders.select("o_orderkey", "o_custkey")
    parts = [orders.where("o_orderkey < 700"), orders.where("o_orderkey >= 700")]
    for part in parts:
        part.write.mode("append").parquet(f"{root}/inbox")
        stream = incremental.stream_files(spark, f"{root}/inbox", orders.schema, "parquet")
        incremental.incremental_load(stream, lambda b: b, f"{root}/table", f"{root}/checkpoint")
    out = incremental.loaded(spark, f"{root}/table").select("o_orderkey", "o_custkey")
    assert out.exceptAll(orders).isEmpty() and orders.exceptAll(out).isEmpty()


def test_known_keys_are_not_loaded_again(spark, frame):
    root = work_area(spark, "seen")
    for batch in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d"), (3, "d")]):
        frame(batch, "k int, v string").write.mode("append").parquet(f"{root}/inbox")
        stream = incremental.stream_files(spark, f"{root}/inbox", "k int, v string", "parquet")
        incremental.load_unseen(stream, lambda b: b, ["k"], f"{root}/table", f"{root}/checkpoint")
    assert rows(incremental.loaded(spark, f"{root}/table")) == [(1, "a"), (2, "b"), (3, "d")]


def test_key_mark_moves_only_on_commit(spark, frame):
    state = work_area(spark, "mark")
    keys = ["a", "b"]
    df = frame([(1, 1), (1, 2)], "a int, b int")
    fresh, commit = incremental.scan_incremental(df, keys, state)
    assert fresh.count() == 2
    commit()
    more = df.unionByName(frame([(1, 3), (2, 0), (0, 9)], "a int, b int"))
    fresh, _ = incremental.scan_incremental(more, keys, state)
    assert rows(fresh) == [(1, 3), (2, 0)]


def test_tags_of_genes_with_five_digits_stay_apart(spark, tmp_path):
    """Genes 1234 and 12345 have different tags, so a row of statistics is loaded once."""
    for name, sql in {
        "part": "SELECT id AS p_partkey FROM VALUES (24680L), (246900L), (246910L) AS v(id)",
        "customer": "SELECT 5L AS c_custkey, 1 AS c_nationkey",
        "orders": "SELECT 1L AS o_orderkey, 5L AS o_custkey",
        "lineitem": "SELECT 1L AS l_orderkey, id AS l_partkey FROM VALUES (24680L), (246900L), (246910L) AS v(id)",
    }.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    out = registry.all_queries()["load_locus_stats"](spark, str(tmp_path))
    assert rows(out.select("sample_id", "gene_db_crossref_id", "coverage_10x")) == [(5, 1234, 1.0), (5, 12345, 0.9)]


# ------------------------------------------------------------------ submissions and quality
def test_resubmission_needs_exactly_two_shared_files(frame):
    entries = frame([("n", "h1"), ("n", "h2"), ("m", "h3"), ("k", "h4"), ("k", "h5"), ("k", "h6")], "strain_id string, md5 string")
    existing = frame([("old", "h1"), ("old", "h2"), ("old2", "h3"), ("old3", "h4"), ("old3", "h5"), ("old3", "h6")], "sample_name string, md5 string")
    assert rows(submissions.detect_resubmissions(entries, existing)) == [("n", "old")]


def test_only_hashes_of_existing_samples_are_paired(frame):
    entries = frame([("n", f"h{i}") for i in range(300)] + [("m", "h1")], "strain_id string, md5 string")
    existing = frame([("old", "h1"), ("old", "h2"), ("none", "x1"), ("none", "x2")], "sample_name string, md5 string")
    found = submissions.detect_resubmissions(entries, existing)
    assert rows(found) == [("n", "old")]
    # What meets on pairs of hashes are strains with such hashes only: nothing is paired before the semi join.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 1 and plan.index("Generate") < plan.index("LeftSemi")


def test_general_sheet_without_dates(frame):
    sheet = frame([("A", "fr", ""), ("A", "", "blood")], "`Strain ID` string, `Country origin` string, `Sample type` string")
    countries = frame([("FR", "FRA", 250)], "alpha2 string, alpha3 string, country_code int")
    out = submissions.parse_general_sheet(sheet, countries, "2024-01-01").collect()
    assert [(r.sample_name, r.labno, r.sampling_date, r.isolation_source, r.country_code) for r in out] == [("A", "A", None, "blood", 250)]


def test_weighted_median_takes_the_row_before(frame):
    regions = frame(
        [(1, 0, 10, 5.0), (1, 10, 20, 7.0), (1, 20, 30, 9.0), (2, 0, 10, 4.0), (3, 0, 1, 1.0), (3, 1, 20, 6.0), (3, 20, 60, 6.0), (3, 60, 61, 9.0), (4, 0, 30, 2.0), (4, 30, 40, 8.0)],
        "sample_id int, start int, end int, depth double",
    )
    # 3: the first row of depth 6 does not pass one half, the second does: the row before has depth 6 too.
    assert rows(qc.weighted_median(regions)) == [(1, 5.0), (2, 4.0), (3, 6.0), (4, 2.0)]


def test_report_lines(frame):
    lines = frame([("s", "SN\traw total sequences:\t10\t# all"), ("s", "SN\terror rate:\t1.5e-03\t# x"), ("s", "FFQ\tnoise: 3")], "sample_id string, value string")
    assert rows(tables.parse_report(lines)) == [("s", "error rate", 0.0015), ("s", "raw total sequences", 10.0)]


def test_feature_lines_of_both_kinds(frame):
    lines = frame([("#c",), ("chr1\ts\tgene\t1\t9\t.\t+\t.\tlocus_tag=Rv1;gene=a b",), ('chr1\ts\texon\t2\t5\t.\t-\t.\ttranscript_id "T.1"; gene_id "G";',)], "value string")
    out = [(r.feature, r.start, r.end, r.attributes) for r in tables.parse_gff(lines).collect()]
    assert out == [("gene", 1, 9, {"locus_tag": "Rv1", "gene": "a b"}), ("exon", 2, 5, {"transcript_id": "T.1", "gene_id": "G"})]


# ------------------------------------------------------------------ browser
def test_documents_are_valid_json_and_hot_genes_are_split(frame):
    results = frame([(i, 1, 2, 0.123456789, float("nan"), "g1") for i in range(40)] + [(0, 3, 4, 2.0, 1e-7, "g2")],
                    "ID int, ac_case int, ac_ctrl int, af float, odds_ratio float, analysis_group string")
    annotations = frame([(i, f"chr1:{i + 1}:A:C", 'say "x"', "7" if i else "8", "NC:c.1A>C", None) for i in range(40)],
                        "ID int, `Variant ID` string, Consequence string, gene_id string, HGVSc string, HGVSp string")
    gene_rows = frame([("7", "g1", 3, 4)], "gene_id string, analysis_group string, susceptible_genotyped int, resistant_genotyped int")
    genes = frame([("7", "chr", 10, 21, ["a", "b"]), ("8", "chr", 30, 41, ["c"])], "gene_id string, chrom string, start int, stop int, search_terms array<string>")
    by_variant, by_gene = browser.variant_results(results, annotations), browser.gene_results(gene_rows)
    whole, split = ({r.name: r.body for r in browser.browser_documents(*browser.combine_browser(genes, by_gene, by_variant, n)).collect()} for n in (1000, 10))
    bodies = {name: json.loads(body) for name, body in whole.items()}
    assert bodies["7.json"] == ["7", ["a", "b"]]
    assert bodies["7_tb.json"] == ["7", "7", "7", "chr", 15, [[3, 4]]]
    assert bodies["8_tb_variants.json"] == {"variants": [["1-1-A-C", 1, 'say "x"', "c.1A>C", None, [1, "", 0], [[1, 2, 0.12346, "NaN"], [3, 4, 2, 1e-7]]]]}
    assert bodies["7_tb_variants.json"]["variants"][0][6][1] is None
    assert bodies["8_h37Rv.json"]["gene"]["start"] == 30
    several = [json.loads(b)["variants"] for n, b in split.items() if n.startswith("7_tb_variants_")]
    assert len(several) > 1 and sorted(v[0] for part in several for v in part) == sorted(v[0] for v in bodies["7_tb_variants.json"]["variants"])


def test_no_variant_is_left_out_by_its_place(frame):
    """Positions beyond the reference, below one and missing ones keep their rows, down to the documents; a place that is no number raises."""
    results = frame([(1, 2, "g1"), (2, 3, "g1"), (4, 5, "g2")], "ID int, ac_case int, analysis_group string")
    kinds = "ID int, `Variant ID` string, Consequence string, gene_id string, HGVSc string, HGVSp string"
    places = {1: "chr1:4411532:A:C", 2: "chr1:4411533:A:C", 3: "chr1:0:A:C", 4: None}
    out = browser.variant_results(results, frame([(i, p, f"v{i}", "7", None, None) for i, p in places.items()], kinds))
    found = {r.consequence: (r.locus.position, r.alleles, sorted(r.group_results or {})) for r in out.collect()}
    assert found == {"v1": (4411532, ["A", "C"], ["g1"]), "v2": (4411533, ["A", "C"], ["g1"]), "v3": (0, ["A", "C"], []), "v4": (None, [None, None], ["g2"])}
    genes, by_gene = frame([("7",)], "gene_id string"), browser.gene_results(frame([("7", "g1", 3)], "gene_id string, analysis_group string, n int"))
    _, documents = browser.combine_browser(genes, by_gene, out)
    assert sorted(v.consequence for r in documents.collect() for v in r.variants) == ["v1", "v2", "v3", "v4"]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        browser.variant_results(results, frame([(1, "chr1:x:A:C", "v", "7", None, None)], kinds)).collect()


def test_feature_lines_and_genes_are_read_once(frame):
    """Genes, transcripts and exons do not each parse the lines again, nor does each document of a gene join its results again."""
    lines = frame([(f"chr1\ts\t{kind}\t1\t9\t.\t+\t.\tDbxref_GeneID=7;locus_tag=Rv7;transcript_id=T7.1",) for kind in ("gene", "transcript", "exon")], "value string")
    models = genes.gene_models(tables.parse_gff(lines))
    assert "str_to_map" not in models._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.gene_id, r.search_terms, r.transcripts[0].exons[0].stop) for r in models.collect()] == [("7", ["7", "Rv7"], 9)]
    by_gene = browser.gene_results(frame([("7", "g1", 3)], "gene_id string, analysis_group string, susceptible_genotyped int"))
    results = frame([(1, 2, "g1")], "ID int, ac_case int, analysis_group string")
    annotations = frame([(1, "chr1:1:A:C", "x", "7", "c.1A>C", None)], "ID int, `Variant ID` string, Consequence string, gene_id string, HGVSc string, HGVSp string")
    documents = browser.browser_documents(*browser.combine_browser(models, by_gene, browser.variant_results(results, annotations)))
    assert documents._jdf.queryExecution().analyzed().toString().count("Union") == 1
    assert sorted((r.folder, r.name) for r in documents.collect()) == [
        ("genes/007", "7_h37Rv.json"), ("genes/007", "7_tb_variants.json"), ("results", "7_tb.json"), ("search", "7.json")
    ]


def test_a_task_reads_a_bounded_part_of_a_shuffle(spark):
    """Calls take ten times their compressed size in a task, so less than Spark's own size is merged; a session that names a size keeps it."""
    from strainwise.session import TASK_SIZE, configure

    key, size = TASK_SIZE
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert configure(spark).conf.get(key) == size == "16m"
        spark.conf.set(key, "8m")
        assert configure(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before)


# ------------------------------------------------------------------ loads and upserts
def test_rows_that_arrive_during_a_run_are_left_to_the_next(spark, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")

    def write(first, last):
        spark.range(first, last).write.mode("append").parquet(table)

    write(0, 5)
    fresh, commit = incremental.scan_incremental(spark.read.parquet(table), ["id"], state)
    write(5, 9)  # between scan and commit
    assert sorted(r.id for r in fresh.collect()) == [0, 1, 2, 3, 4]
    commit()
    fresh, commit = incremental.scan_incremental(spark.read.parquet(table), ["id"], state)
    assert sorted(r.id for r in fresh.collect()) == [5, 6, 7, 8]
    commit()
    assert incremental.scan_incremental(spark.read.parquet(table), ["id"], state)[0].count() == 0


def test_null_keys_have_no_place_in_the_order(spark, tmp_path):
    table = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    with pytest.raises(ValueError):
        incremental.scan_incremental(table, ["id"], str(tmp_path / "s"))


def test_null_keys_are_loaded_once(spark, tmp_path):
    inbox, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "check"))
    for rows in ([(1, "b"), (1, "a"), (None, "n")], [(None, "m"), (1, "c"), (2, "d")]):
        spark.createDataFrame(rows, "k long, v string").write.mode("append").parquet(inbox)
        stream = incremental.stream_files(spark, inbox, "k long, v string", "parquet")
        incremental.load_unseen(stream, lambda b: b, ["k"], target, checkpoint)
    found = incremental.loaded(spark, target).collect()
    assert sorted(((r.k, r.v) for r in found), key=repr) == sorted([(1, "a"), (None, "n"), (2, "d")], key=repr)


def test_upsert_takes_one_incoming_row_whole(frame):
    current = frame([("s1", 7, "old", "C0"), ("s2", 8, "old", "C0")], "name string, id int, origin string, country string")
    incoming = frame([("s1", "C9", "aa"), ("s1", "C1", "zz"), ("s3", None, "x")], "name string, country string, origin string")
    out = sinks.upsert_coalesce(current, incoming, ["name"], ["country", "origin"])
    assert rows(out) == [("s1", 7, "zz", "C1"), ("s2", 8, "old", "C0"), ("s3", None, "x", None)]


def test_short_feature_lines_are_refused(frame):
    lines = frame([("# comment",), ("",), ("chr\tsrc\tgene\t1",)], "value string")
    with pytest.raises(Exception, match="not a feature line"):
        tables.parse_gff(lines).collect()


def test_split_queries_become_derived_tables():
    split = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    assert tables.jdbc_options("SELECT 1") == {"query": "SELECT 1"}
    assert tables.jdbc_options("SELECT id FROM a", split) == {"dbtable": "(SELECT id FROM a) t", **split}


def test_late_rows_are_found_once(spark, tmp_path):
    table, state = str(tmp_path / "t"), str(tmp_path / "s")

    def arrive(*ids):
        spark.createDataFrame([(i, str(i)) for i in ids], "id int, v string").write.mode("append").parquet(table)

    def scan():
        fresh, commit = incremental.scan_with_late_rows(spark.read.parquet(table), ["id"], state, 5)
        return sorted(r["id"] for r in fresh.collect()), commit

    arrive(1, 10, 12)
    assert scan()[0] == [1, 10, 12]
    found, commit = scan()  # nothing was marked as taken
    arrive(13)  # between scan and commit
    commit()
    assert found == [1, 10, 12]
    arrive(2, 7, 11)  # 2 lies below the window
    found, commit = scan()
    assert found == [7, 11, 13]
    commit()
    found, commit = scan()
    assert found == []
    commit()
    assert scan()[0] == []


def test_late_rows_of_an_empty_table(spark, tmp_path):
    fresh, commit = incremental.scan_with_late_rows(spark.createDataFrame([], "id int"), ["id"], str(tmp_path / "s"), 5)
    assert fresh.count() == 0 and commit() is None
    with pytest.raises(ValueError, match="1 rows"):
        incremental.scan_with_late_rows(spark.createDataFrame([(None,), (1,)], "id int"), ["id"], str(tmp_path / "s"), 5)


def test_failure_between_two_tables_leaves_each_row_once(spark, tmp_path):
    inbox, target, checkpoint = (str(tmp_path / n) for n in ("inbox", "tables", "checkpoint"))
    schemas = {"one": "`Strain ID` string, `RIF (0,2)` string", "two": "`Strain ID` string, EMB string"}

    def arrive(sheet, *rows):
        spark.createDataFrame(rows, schemas[sheet]).coalesce(1).write.mode("append").option("header", True).csv(f"{inbox}/{sheet}")

    def load(broken=False):
        def second(rows):
            if broken:
                raise RuntimeError("lost between the tables")
            return rows

        incremental.arrival_triggered_ingest(
            spark, inbox, {"one": lambda rows: rows.withColumnsRenamed({"RIF (0,2)": "rif"}), "two": second}, schemas, target, checkpoint
        )

    arrive("one", ("a", "R(0,5)"), ("b", None))
    arrive("two", ("a", "S"))
    with pytest.raises(Exception, match="lost between"):
        load(broken=True)
    assert incremental.loaded(spark, f"{target}/one").count() == 2
    arrive("one", ("c", "S"))
    load()
    load()
    assert rows(incremental.loaded(spark, f"{target}/one")) == [("a", "R(0,5)"), ("b", None), ("c", "S")]
    assert rows(incremental.loaded(spark, f"{target}/two")) == [("a", "S")]


def test_lines_without_the_first_name_are_taken_apart_once(spark):
    """The plan tests for a header only where the first column's name is in the line."""
    lines = spark.createDataFrame([("id,drug",), ("a,id",), ("b,c",)], "value string")
    found = incremental.sheet_rows(lines, "id string, drug string")
    assert rows(found) == [("a", "id"), ("b", "c")]
    assert "Contains(value" in found._jdf.queryExecution().optimizedPlan().toString()


def test_sheets_with_another_header_are_refused(spark):
    def parse(*lines):
        return incremental.sheet_rows(spark.createDataFrame([(x,) for x in lines], "value string"), "id string, drug string").collect()

    assert [tuple(r) for r in parse("id,drug", "", 'a,"x,y"', "b,")] == [("a", "x,y"), ("b", None)]
    for wrong in ("id,medium", "a,b,c"):
        with pytest.raises(Exception):
            parse(wrong)
