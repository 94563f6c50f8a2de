from pyspark.sql import functions as F

from conftest import rows
from strainwise.operators import classify, cohort, lineage, predict
from strainwise.plans.derived import Inputs

SMALL = "/root/testdata/sf0.001"
CALLS = "sample_id int, drug_id int, tier int, gene_db_crossref_id int, variant_category string, phenotype string"


def test_solo_samples(frame):
    calls = frame(
        [
            (1, 1, 1, 1, "a", "R"), (1, 1, 1, 1, "a", "R"), (1, 1, 2, 5, "x", "R"),  # one in tier 1
            (2, 1, 1, 1, "a", "R"), (2, 1, 1, 1, "b", "R"),  # two in tier 1
            (3, 1, 2, 5, "x", "R"),  # none in tier 1, one in tier 2
            (4, 1, 2, 5, "x", "R"), (4, 1, 2, 5, "y", "R"),
        ],
        CALLS,
    )
    assert rows(classify.solo_samples(calls)) == [(1, 1, 1), (3, 1, 2)]


def test_counts_ignore_repeated_calls(frame):
    calls = frame([(1, 1, 1, 1, "a", "R"), (1, 1, 1, 1, "a", "R"), (2, 1, 1, 1, "a", "S"), (3, 1, 1, 1, "a", None)], CALLS)
    assert rows(classify.phenotype_counts(calls)) == [(1, 1, 1, "a", 1, 1)]


def test_neutral_sets_do_not_overlap(spark):
    t = Inputs(spark, SMALL)
    gene = t.gene_name.withColumnRenamed("gene_name", "gene_symbol")
    wide, neutral, modal = classify.neutral_variants(
        t.cohort, t.clean_phenotype, t.variant_category, t.genotype, t.drug, gene, t.variant_info, 0.95
    )
    key = classify.CATEGORY_KEY
    solo = neutral.where(F.col("set").isin("D1", "D2", "M"))
    first = neutral.where(F.col("set").isin("A", "B"))
    assert solo.join(first, key, "left_semi").isEmpty()
    assert solo.groupBy(*key).count().where("count > 1").isEmpty()
    assert wide.count() == wide.select(*key).distinct().count()
    assert modal.count() == modal.select(*key[2:]).distinct().count()
    report = classify.neutral_report(neutral, t.drug, t.symbol, t.locus_tag, modal)
    assert {"Drug", "Gene", "LocusTag", "Tier", "Variant", "Effect", "ModalPosition", "Set"} <= set(report.columns)


def test_epistasis_overrules(frame):
    grades = frame(
        [(1, 1, 0, "mmpL5_lof"), (1, 1, 1, "Rv0678_x"), (2, 1, 2, "b"), (2, 1, 1, "a"), (2, 1, 1, "a")],
        "sample_id int, drug_id int, grade int, variant_catalogue_name string",
    )
    mutations = predict.min_grade_mutations(grades)
    assert rows(mutations) == [(1, 1, 0, "mmpL5_lof"), (2, 1, 1, "a; b")]
    drug = frame([(1, "Bedaquiline"), (2, "Amikacin")], "drug_id int, drug_name string")
    samples = frame([(1,), (2,), (2,)], "sample_id int")
    uncalled = frame([(1, 2), (2, 1)], "sample_id int, drug_id int")
    out = {(r.sample_id, r.drug_id): (r.resistance_flag, r.variant) for r in predict.predict_v2(samples, mutations, uncalled, drug).collect()}
    assert out == {(1, 1): ("S", "mmpL5_lof"), (1, 2): ("U", ""), (2, 1): ("R", "a; b"), (2, 2): ("S", "")}


def test_pyrazinamide_needs_rifampicin(frame):
    samples = frame([(1,), (2,), (3,)], "sample_id int")
    interest = frame(
        [
            (1, "Pyrazinamide", 9, True, "pncA", "p.Ala1Gly"), (1, "Rifampicin", 8, False, "rpoB", "p.Ser450Leu"),
            (2, "Pyrazinamide", 9, True, "pncA", "p.Ala1Gly"),
            (3, "Pyrazinamide", 9, True, "pncA", "p.Ala1Gly"), (3, "Pyrazinamide", 7, False, "pncA", "p.His51Gln"),
        ],
        "sample_id int, drug string, variant_id int, with_rifampicin boolean, gene_name string, hgvs_value string",
    )
    loss = frame([(2, "Isoniazid", 0.5, "katG", "deletion")], "sample_id int, drug string, coverage_10x double, gene_name string, hgvs_value string")
    uncovered = frame([(2, "Amikacin"), (2, "Amikacin")], "sample_id int, drug string")
    drug = frame([(i, n) for i, n in enumerate(["Pyrazinamide", "Rifampicin", "Isoniazid", "Amikacin"], 1)], "drug_id int, drug_name string")
    out = predict.predict_v1(samples, interest, loss, uncovered, drug)
    assert out.count() == 3 * 12
    found = {(r.sample_id, r.drug_id): (r.resistance_flag, r.variant) for r in out.where("drug_id is not null").collect()}
    assert found[1, 1] == ("R", "pncA_p.Ala1Gly")
    assert found[2, 1] == ("S", "")
    assert found[3, 1] == ("R", "pncA_p.Ala1Gly;pncA_p.His51Gln")
    assert found[2, 3] == ("R", "katG_deletion")
    assert found[2, 4] == ("U", "")
    assert found[1, 2] == ("R", "rpoB_p.Ser450Leu")


def test_rule_variants(frame):
    annotation = frame(
        [
            (1, "katG", "frameshift_variant&stop_gained", "p.X", 5), (2, "katG", "missense_variant", "p.Ala1Gly", 1), (3, "rpoB", "missense_variant", "p.Ala430Gly", 430),
            (4, "rpoB", "synonymous_variant", "p.Ala430Ala", 430), (5, "pncA", "missense_variant", "p.Ile6Leu", 6), (6, "pncA", "missense_variant", "p.Ala3Gly", 3),
            (7, "pncA", "missense_variant", "p.His51Gln", 51), (8, "rrs", "non_coding_transcript_exon_variant", "n.1401A>G", None), (9, "gyrA", "missense_variant", "p.Ala90Val", 90),
        ],
        "variant_id int, gene_name string, predicted_effect string, hgvs_value string, mii int",
    )
    out = predict.rule_variants_v1(annotation).collect()
    assert {(r.variant_id, r.drug, r.with_rifampicin) for r in out} == {
        (1, "Isoniazid", False), (3, "Rifampicin", False), (6, "Pyrazinamide", True), (7, "Pyrazinamide", False),
        (8, "Amikacin", False), (8, "Capreomycin", False), (8, "Kanamycin", False), (9, "Levofloxacin", False), (9, "Moxifloxacin", False),
    }


def test_known_markers(frame):
    calls = frame(
        [
            (1, 1, 1, "p.Ser315Asn", "missense_variant", 944), (2, 1, 1, "p.Ala3Gly", "missense_variant", 9),
            (3, 2, 2, "p.Ala430Gly", "missense_variant", 1290), (4, 2, 2, "c.1290A>G", "synonymous_variant", 1290),
            (5, 3, 3, "p.Leu35Arg", "missense_variant", 104), (6, 3, 3, "p.Ala3Gly", "missense_variant", 9), (7, 3, 3, "c.-11A>G", "upstream_gene_variant", 11), (8, 3, 3, "c.-7T>C", "upstream_gene_variant", 7),
            (9, 4, 4, "p.Ala1Gly", "missense_variant", 3), (10, 4, 4, "p.Asp94Gly", "missense_variant", 281),
        ],
        "sample_id int, drug_id int, gene_db_crossref_id int, variant_category string, predicted_effect string, distance_to_reference long",
    )
    drug = frame([(1, "Isoniazid"), (2, "Rifampicin"), (3, "Pyrazinamide"), (4, "Levofloxacin")], "drug_id int, drug_name string")
    gene = frame([(1, "katG"), (2, "rpoB"), (3, "pncA"), (4, "gyrA")], "gene_db_crossref_id int, gene_symbol string")
    out = classify.known_marker_samples(calls, drug, gene)
    assert rows(out) == sorted([(1, 1), (3, 2), (6, 3), (7, 3), (10, 4)], key=repr)


def test_uncovered_genes_are_added_unless_deleted(frame):
    sample_drug = frame([(1, 1), (2, 1)], "sample_id int, drug_id int")
    calls = frame(
        [(1, 1, 1, 7, "p.A", "frameshift", 0.5, 10.0), (1, 1, 1, 7, "p.A", "frameshift", 0.9, 5.0)],
        "sample_id int, drug_id int, tier int, gene_db_crossref_id int, variant_category string, predicted_effect string, af double, quality double",
    )
    stats = frame([(1, 7, 0.9), (2, 7, 0.9), (2, 8, 1.0)], "sample_id int, gene_db_crossref_id int, coverage_10x double")
    tier = frame([(7, 1, 1), (8, 1, 2)], "gene_db_crossref_id int, drug_id int, tier int")
    drug, symbol = frame([(1, "D")], "drug_id int, drug_name string"), frame([(7, "g7"), (8, "g8")], "gene_db_crossref_id int, resolved_symbol string")
    positions = frame([(7, "p.A", "frameshift", "12;13")], "gene_db_crossref_id int, variant_category string, predicted_effect string, position string")
    out = cohort.genotype_extract(sample_drug, calls, positions, stats, drug, symbol, tier)
    assert rows(out) == [("D", 1, 1, "g7", "p.A", "frameshift", None, 0.9, 10.0, "12;13"), ("D", 2, 1, "g7", None, None, None, None, None, None)]
    assert rows(cohort.missing_tier_samples(sample_drug, calls, stats, tier, drug)) == [("D", 2, 1)]


def test_calls_and_loci_of_the_cohort(spark):
    """Derived from the cohort's orders alone they are the rows that a filter by sample leaves of all."""
    inputs = Inputs(spark, SMALL)
    for name in ("genotype", "locus_stats"):
        whole, of_cohort = getattr(inputs, name), getattr(inputs.of_cohort(), name)
        wanted = rows(whole.join(inputs.cohort, "sample_id", "left_semi"))
        assert 0 < len(wanted) < whole.count()
        assert rows(of_cohort.select(*whole.columns)) == wanted


def test_lineage_markers(frame):
    markers = frame([(1, 100, True, 1), (2, 200, False, 2), (3, 200, False, 2)], "variant_id int, position int, count_presence boolean, lineage_id int")
    names = frame([(1, "4.1"), (2, "4.9")], "id int, lineage_numbering string")
    samples = frame([(1,), (2,), (3,)], "sample_id int")
    calls = frame(
        [(1, 1, "bcftools", 3, 4), (2, 2, "bcftools", 1, 4), (2, 3, "bcftools", 1, 2), (3, 3, "bcftools", 4, 4), (3, 1, "freebayes", 4, 4)],
        "sample_id int, variant_id int, genotyper string, alternative_ad int, total_dp int",
    )
    out = lineage.lineage_marker_frequencies(markers, names, samples, calls)
    assert rows(out) == [(1, 100, "4.1", 0.75), (1, 200, "4.9", 1.0), (2, 200, "4.9", 0.25)]
