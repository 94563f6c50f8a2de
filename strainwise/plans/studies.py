"""Whole studies: compositions of the operators over a set of named tables.

``tables`` maps table names to DataFrames (see :func:`load_tables`).  Frames that feed
several results are written once with :func:`cut_lineage`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainwise import schemas
from strainwise.operators import classify, cohort, genes, lineage, phenotypes, predict, variants
from strainwise.session import cut_lineage
from strainwise.sources import sinks, tables as sources

Tables = dict[str, DataFrame]


def load_tables(spark: SparkSession, names: list[str], root: str | None = None) -> Tables:
    """Catalogue tables, or parquet tables below ``root``."""
    return {name: sources.scan_table(spark, name, root) for name in names}


def gene_views(t: Tables) -> dict[str, DataFrame]:
    """Symbol, locus tag, resolved symbol, protein link and forward-strand stop codons."""
    stores = (t["seqfeature_dbxref"], t["seqfeature_qualifier_value"], t["seqfeature"], t["term"])
    symbol, locus = genes.gene_label(*stores, "gene"), genes.gene_label(*stores, "locus_tag")
    protein = genes.protein_to_gene(t["dbxref"], t["seqfeature_qualifier_value"], t["seqfeature_dbxref"])
    return {
        "symbol": symbol,
        "locus": locus,
        "resolved": genes.resolved_symbol(symbol, locus),
        "protein": protein,
        "stops": genes.positive_strand_stop(t["location"], t["seqfeature_dbxref"], protein),
    }


def categorised_variants(t: Tables, views: dict[str, DataFrame], unpool_frameshifts: bool = False) -> DataFrame:
    """Categories with gene rank; annotations and decomposed variants are written once."""
    tier, variant = t["genedrugresistanceassociation"], t["variant"]
    fapg = cut_lineage(
        variants.formatted_annotation_per_gene(t["varianttoannotation"], t["annotation"], t["dbxref"], views["protein"])
    )
    mnv = cut_lineage(variants.decompose_mnv(variant))
    return cut_lineage(
        variants.ranked_variant_categories(
            fapg,
            variants.pure_synonymous_mnv(fapg, tier, mnv),
            tier,
            variant,
            mnv,
            t["promoterdistance"],
            variants.missense_codons(fapg, variant, tier),
            unpool_frameshifts,
        )
    )


def counted_categories(t: Tables, ranked: DataFrame) -> DataFrame:
    return variants.exclude_listed_variants(variants.tiered_variant_categories(ranked), t["variant"])


def study_phenotypes(t: Tables) -> DataFrame:
    """Clean phenotypes of published tests: all tests, at the cut-off, and one concentration below."""
    tests = t["pdstest"].where(~F.col("staging"))
    mic = phenotypes.normalise_plate_names(
        t["mictest"].where(~F.col("staging")).withColumnRenamed("range", "mic_value")
    )
    drug, tier = t["drug"], t["genedrugresistanceassociation"]
    cutoff, plates = t["epidemcutoffvalue"], t["microdilutionplateconcentration"]
    clean = phenotypes.clean_binary_phenotypes(
        tests, t["pdstestcategory"], drug, t["growthmedium"], t["pdsassessmentmethod"], mic, cutoff, tier, plates
    )
    return clean.unionByName(phenotypes.cc_phenotypes(mic, drug, plates, cutoff, tier))


def association_study(t: Tables, unpool_frameshifts: bool = False) -> dict[str, DataFrame]:
    """Everything the association step needs: phenotype boxes, overviews, identifiers, lineages, matches, genotypes."""
    views = gene_views(t)
    found = cut_lineage(study_phenotypes(t))
    samples = cut_lineage(cohort.qc_samples(t["sequencingdata"], t["summarysequencingstats"], found))
    boxes = cohort.phenotype_boxes(found, samples, t["drug"])
    categories = cut_lineage(counted_categories(t, categorised_variants(t, views, unpool_frameshifts)))
    calls = cut_lineage(cohort.categorised_genotypes(t["genotype"], categories, samples))
    pairs = found.join(samples, "sample_id", "left_semi").select("sample_id", "drug_id").distinct()
    sample = t["sample"].withColumnRenamed("id", "sample_id")
    tier, drug, resolved = t["genedrugresistanceassociation"], t["drug"], views["resolved"]
    positions = variants.category_positions(categories)
    markers = lineage.assign_marker_variants(t["variantlineageassociation"], t["variant"])
    return {
        "phenotypes": boxes,
        "drug_sample_overview": cohort.drug_overview(boxes),
        "samples_per_country": cohort.samples_per_country(samples, sample, t["samplealias"], t["country"]),
        "identifiers": cohort.sample_identifiers(samples, t["samplealias"], t["sequencingdata"]),
        "lineages_counts": lineage.lineage_marker_frequencies(markers, t["lineage"], samples, t["genotype"]),
        "prev_version_matching": cohort.match_previous_catalogue(
            t["variantadditionalinfo"], t["variant"], categories, resolved
        ),
        "prev_version_grades": cohort.match_previous_grades(t["variantgrade"], categories, drug, resolved),
        "missing_sample_drug_tier": cohort.missing_tier_samples(
            pairs, calls, t["locussequencingstats"], tier, drug
        ),
        "full_genotypes": cohort.genotype_extract(
            pairs, calls, positions, t["locussequencingstats"], drug, resolved, tier
        ),
    }


PARTITIONED = {
    "phenotypes": ["drug_name"],
    "missing_sample_drug_tier": ["drug_name", "tier"],
    "full_genotypes": ["drug_name", "tier"],
}


def write_study(results: dict[str, DataFrame], root: str) -> None:
    """One folder per result, partitioned where readers select by drug and tier."""
    for name, result in results.items():
        if name in PARTITIONED:
            sinks.write_partitioned_csv(result, f"{root}/{name}", PARTITIONED[name])
        else:
            sinks.write_single_csv(result, f"{root}/{name}")


def variant_mapping(t: Tables, sample_fraction: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Catalogue names with coordinates, and the variants that reach two genes."""
    views = gene_views(t)
    ranked = categorised_variants(t, views)
    mapping = variants.variant_catalogue_map(
        variants.tiered_variant_categories(ranked), t["variant"], views["resolved"], views["stops"], sample_fraction
    )
    return mapping, variants.overlap_report(ranked, views["resolved"])


def neutral_study(
    t: Tables, threshold: float = 0.1, keep_synonymous: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Predictive values of all sets, and the neutral variants, both with names."""
    views = gene_views(t)
    tests = phenotypes.categorise_tests(
        t["pdstest"], t["pdstestcategory"], t["drug"], t["growthmedium"], t["pdsassessmentmethod"]
    )
    clean = cut_lineage(phenotypes.who_only_phenotypes(tests))
    samples = cut_lineage(cohort.qc_samples(t["sequencingdata"], t["summarysequencingstats"], clean))
    categories = variants.tiered_variant_categories(categorised_variants(t, views))
    if not keep_synonymous:
        categories = categories.where(F.col("predicted_effect") != "synonymous_variant")
    listed = t["variantadditionalinfo"].where(F.col("description") == "merker_neutral_variant")
    wide, neutral, positions = classify.neutral_variants(
        samples, clean, cut_lineage(categories), t["genotype"], t["drug"], views["symbol"], listed, threshold
    )
    named = (t["drug"], views["resolved"], views["locus"], cut_lineage(positions))
    return classify.neutral_report(wide, *named), classify.neutral_report(neutral, *named)


def predict_with_first_rules(t: Tables) -> DataFrame:
    samples = cut_lineage(
        predict.annotated_samples(
            t["package"], t["samplealias"], t["sample"], t["sequencingdata"], t["locussequencingstats"]
        )
    )
    stats, names = t["locussequencingstats"], t["genename"]
    interest = predict.genotypes_of_interest(
        t["genotype"], samples, predict.rule_variants_v1(t["preferredannotation"])
    )
    predicted = predict.predict_v1(
        samples,
        interest,
        predict.loss_by_coverage_v1(stats, samples, names),
        predict.uncovered_rrs(stats, samples, names),
        t["drug"],
    )
    return sinks.align_to_schema(predicted, schemas.struct_type(schemas.PREDICTION))


def predict_with_second_rules(t: Tables) -> DataFrame:
    views = gene_views(t)
    sample = t["sample"].withColumnRenamed("id", "sample_id")
    categories = predict.named_categories(counted_categories(t, categorised_variants(t, views)), views["resolved"])
    grade = t["variantgrade"]
    if not grade.where(F.col("variant_id").isNull()).isEmpty():
        grade = predict.min_grade_by_allele(grade, t["variant"])
    graded = cut_lineage(predict.graded_variants(categories, grade, t["drug"]))
    stats = t["locussequencingstats"]
    loss = predict.loss_by_coverage_v2(stats, views["resolved"], t["drug"])
    mutations = predict.min_grade_mutations(predict.sample_grades(t["genotype"], sample, graded, loss))
    uncalled = predict.uncalled_genes(stats, sample, views["resolved"], t["drug"])
    predicted = predict.predict_v2(stats, mutations, uncalled, t["drug"])
    return sinks.align_to_schema(predicted, schemas.struct_type(schemas.PREDICTION))
