import pytest
from pyspark.sql import functions as F

from conftest import rows
from strainwise.operators import phenotypes as ph

MIC = "id int, sample_id int, drug_id int, plate string, mic_value string, package_id int"


@pytest.fixture
def drug(frame):
    names = ["Amikacin", "Moxifloxacin", "Ofloxacin", "Levofloxacin", "Prothionamide", "Ethionamide", "Isoniazid", "Streptomycin"]
    return frame(list(enumerate(names, 1)), "drug_id int, drug_name string")


@pytest.fixture
def medium(frame):
    names = ["Middlebrook7H10", "LJ", "Middlebrook7H11", "Agar", "MGIT", "Sauton", "Ogawa"]
    return frame(list(enumerate(names, 1)), "medium_id int, medium_name string")


@pytest.fixture
def method(frame):
    return frame([(1, "Proportions"), (2, "Ratios")], "method_id int, method_name string")


def test_mic_against_cutoff(frame, drug):
    values = ["(0.5,1]", "[1,1]", "(1,2]", "[2,2]", "(0.5,2]", "(2,)", "(,0.5]"]
    mic = frame([(i, i, 1, "MGIT", v, 1) for i, v in enumerate(values)], MIC)
    cutoff = frame([(1, "MGIT", 1.0)], "drug_id int, medium_name string, value double")
    plate = frame([], "plate string, drug_id int, concentration double")
    out = ph.binarise_mic(mic, cutoff, plate, drug).orderBy("mictest_id").collect()
    assert [r.test_result for r in out] == ["S", "S", "R", "R", None, "R", "S"]
    assert [r.phenotypic_category for r in out][3:5] == ["non_WHO_CC_R", "to_be_excluded"]


def test_mycotb_exclusions(frame, drug):
    mic = frame(
        [(1, 1, 8, "MYCOTB", "(0.5,1]", 1), (2, 1, 7, "MYCOTB", "[0.08,0.08]", 1), (3, 1, 7, "MYCOTB", "[1,1]", 1)], MIC
    )
    cutoff = frame([(7, "MYCOTB", 1.0)], "drug_id int, medium_name string, value double")
    plate = frame([], "plate string, drug_id int, concentration double")
    out = ph.binarise_mic(mic, cutoff, plate, drug).collect()
    assert [(r.mictest_id, r.test_result, r.phenotypic_category) for r in out] == [(3, "S", "MYCOTB_MIC")]


def test_cutoff_below_the_tested_concentration(frame):
    cutoff = frame([(1, "UKMYC5", 1.0), (1, "MGIT", 1.0), (1, "UKMYC6", 0.25)], "drug_id int, medium_name string, value double")
    plate = frame([("UKMYC5", 1, c) for c in (0.25, 0.5, 1.0)] + [("UKMYC6", 1, 0.25)], "plate string, drug_id int, concentration double")
    out = {r.medium_name: r.value for r in ph.atu_cutoffs(cutoff, plate).collect()}
    assert out == {"UKMYC5": 0.5, "MGIT": 0.5, "UKMYC6": 0.0}


def test_cc_and_atu_drop_the_pair_together(frame, drug):
    mic = frame([(1, 1, 1, "UKMYC5", "(0.25,0.5]", 1), (2, 1, 1, "UKMYC5", "(0.5,1]", 1), (3, 2, 1, "UKMYC5", "(0.25,0.5]", 1)], MIC)
    cutoff = frame([(1, "UKMYC5", 1.0)], "drug_id int, medium_name string, value double")
    plate = frame([("UKMYC5", 1, 0.5), ("UKMYC5", 1, 1.0)], "plate string, drug_id int, concentration double")
    tier = frame([(9, 1, 1)], "gene_db_crossref_id int, drug_id int, tier int")
    exact, lowered = ph.clean_cc_phenotypes(mic, drug, plate, cutoff, tier)
    assert [r.sample_id for r in exact.collect()] == [2]
    assert [(r.sample_id, r.phenotype, r.phenotypic_category) for r in lowered.collect()] == [(2, "S", "CC-ATU_CRyPTIC_MIC")]


def test_discordant_medium_is_dropped_before_ranking(frame, medium):
    df = frame(
        [
            (1, 1, 1, "WHO_current", "R"), (1, 1, 1, "WHO_current", "S"), (1, 1, 2, "WHO_current", "S"), (1, 1, 5, "WHO_current", "R"),
            (2, 1, 6, "WHO_past", "R"), (2, 1, 7, "WHO_past", "S"), (3, 1, 1, "to_be_excluded", "R"), (4, 1, 1, "WHO_past", "I"),
        ],
        "sample_id int, drug_id int, medium_id int, phenotypic_category string, test_result string",
    )
    out = ph.consensus_by_medium(df, medium)
    # Two other media tie and are both kept.
    assert rows(out) == [(1, 1, "WHO_current", "S"), (2, 1, "WHO_past", "R"), (2, 1, "WHO_past", "S")]
    assert rows(ph.consensus_by_category(out)) == [(1, 1, "WHO_current", "S")]


def test_categories(frame, drug, medium, method):
    category = frame(
        [(1, 1, 1, 1.0, "WHO_current"), (1, 3, None, 2.0, "WHO_past"), (1, 2, 1, 1.0, "WHO_past"), (1, 2, 1, 4.0, "WHO_undefined"), (1, 5, None, 1.0, "to_be_excluded")],
        "drug_id int, medium_id int, method_id int, concentration double, category string",
    )
    tests = [
        (1, 1, 1, 1, 1.0, "R", "WHO_current"),
        (2, 1, 1, 1, 2.0, "R", "non_WHO_CC_R"),
        (3, 1, 1, None, 2.0, "R", "non_WHO_CC_R"),  # no method counts as proportions
        (4, 1, 1, 2, 2.0, "R", None),
        (5, 1, 1, 1, 0.5, "S", "non_WHO_CC_S"),
        (6, 1, 1, 1, 0.5, "R", None),
        (7, 1, 4, None, 0.5, "S", "non_WHO_CC_S"),  # agar: below the lowest of 1 and 2
        (8, 1, 4, None, 1.5, "S", None),
        (9, 1, 4, 1, 3.0, "R", "non_WHO_CC_R"),  # agar: above the highest
        (10, 1, 4, None, 1.5, "R", None),
        (11, 1, 2, 1, 4.0, "R", "non_WHO_CC_R"),  # conclusive side beats an undefined listing
        (12, 1, 2, 1, 4.0, "S", "WHO_undefined"),
        (13, 2, 5, None, 0.5, "R", "non_WHO_CC_SR"),
        (14, 1, 5, None, 1.0, "R", "to_be_excluded"),
        (15, 1, 3, 1, 3.0, "R", "non_WHO_CC_R"),  # cut-off without method serves proportions
    ]
    df = frame([t[:6] for t in tests], "test_id int, drug_id int, medium_id int, method_id int, concentration double, test_result string")
    out = {r.test_id: r.phenotypic_category for r in ph.categorise_tests(df, category, drug, medium, method).collect()}
    assert out == {t[0]: t[6] for t in tests}


def test_pooling(frame, drug):
    out = ph.pool_drugs(frame([(1, 3), (2, 5), (3, 1), (4, 99)], "test_id int, drug_id int"), drug)
    assert rows(out) == [(1, 4), (2, 6), (3, 1)]


def test_plate_labels(frame):
    df = frame([("Sensititre MYCOTB",), ("Sensititre Custom AST Plates YUKMYC5",), ("Middlebrook7H10",), ("LJ",)], "plate string")
    assert [r[0] for r in ph.normalise_plate_names(df).collect()] == ["MYCOTB", "UKMYC5", "7H10", "LJ"]


def test_who_only_prefers_current(frame):
    df = frame(
        [(1, 1, "WHO_past", "R"), (1, 1, "WHO_current", "S"), (2, 1, "WHO_past", "R"), (3, 1, "WHO_current", "S"), (3, 1, "WHO_current", "R"), (4, 1, "WHO_undefined", "R")],
        "sample_id int, drug_id int, phenotypic_category string, test_result string",
    )
    assert rows(ph.who_only_phenotypes(df)) == [(1, 1, "S"), (2, 1, "R")]


def test_one_phenotype_per_sample_and_drug(spark):
    from strainwise.plans.derived import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    out = ph.consensus_by_category(t.categorised_test)
    assert out.count() == out.select("sample_id", "drug_id").distinct().count()
    assert {r[0] for r in out.select("phenotype").distinct().collect()} <= {"R", "S"}
    assert out.where(F.col("phenotypic_category").isin("to_be_excluded", "non_WHO_CC")).isEmpty()
