"""Whole studies over the derived tables."""

import pytest
from pyspark.sql import functions as F

from strainwise.plans import studies
from strainwise.plans.derived import Inputs
from strainwise.session import work_area


@pytest.fixture(scope="module")
def tables(spark):
    t = Inputs(spark, "/root/testdata/sf0.001")
    return {
        "seqfeature_dbxref": t.seqfeature_dbxref, "seqfeature_qualifier_value": t.qualifier, "seqfeature": t.seqfeature,
        "term": t.term, "dbxref": t.dbxref, "location": t.location, "genedrugresistanceassociation": t.tier,
        "variant": t.variant, "varianttoannotation": t.annotation_link, "annotation": t.annotation,
        "promoterdistance": t.promoter, "pdstest": t.pdstest, "pdstestcategory": t.pdstest_category,
        "mictest": t.mictest.withColumnRenamed("mic_value", "range"), "drug": t.drug, "growthmedium": t.medium,
        "pdsassessmentmethod": t.method, "epidemcutoffvalue": t.cutoff,
        "microdilutionplateconcentration": t.plate_concentration, "sequencingdata": t.sequencing,
        "summarysequencingstats": t.summary_stats, "locussequencingstats": t.locus_stats, "genotype": t.genotype,
        "sample": t.sample.drop("sample_id"), "samplealias": t.sample_alias, "country": t.country,
        "variantlineageassociation": t.lineage_marker, "lineage": t.lineage,
        "variantadditionalinfo": t.variant_info.withColumn("description", F.lit("merker_neutral_variant")),
        "variantgrade": t.variant_grade, "package": t.package, "genename": t.gene_name,
        "preferredannotation": t.preferred_annotation,
    }


def test_association_study_is_written(spark, tables):
    root = work_area(spark, "study")
    results = studies.association_study(tables)
    studies.write_study({k: results[k] for k in ("phenotypes", "full_genotypes", "samples_per_country")}, root)
    back = spark.read.option("header", True).csv(f"{root}/full_genotypes")
    assert back.count() == results["full_genotypes"].count() > 0
    assert {"drug_name", "tier"} <= set(back.columns)
    assert spark.read.option("header", True).csv(f"{root}/samples_per_country").count() > 0


def test_predictions_cover_every_sample_and_drug(tables):
    second = studies.predict_with_second_rules(tables)
    samples = tables["locussequencingstats"].select("sample_id").distinct().count()
    assert second.count() == samples * 17 == second.select("sample_id", "drug_id").distinct().count()
    assert {r[0] for r in second.select("resistance_flag").distinct().collect()} <= {"R", "S", "U"}
    first = studies.predict_with_first_rules(tables)
    assert first.count() % 12 == 0 and first.count() > 0


def test_variant_mapping_and_neutral_study(tables):
    mapping, overlap = studies.variant_mapping(tables)
    assert mapping.count() > 0 and "overlapping_gene" in overlap.columns
    wide, neutral = studies.neutral_study(tables, threshold=0.99)
    assert "Upper_PPV_SOLO_setD2" in wide.columns and "ModalPosition" in neutral.columns
