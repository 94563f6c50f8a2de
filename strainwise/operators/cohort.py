"""Sample cohort, its overviews, and the genotype extract for association studies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions.numeric import allele_fraction
from strainwise.functions.text import first_match, priority, set_text
from strainwise.operators.relational import best_ranked, proportion_ci95


def qc_samples(
    sequencing: DataFrame,
    summary: DataFrame,
    phenotype: DataFrame | None = None,
    min_depth: float = rules.MIN_DEPTH,
    min_cov20: float = rules.MIN_COVERAGE_20X,
) -> DataFrame:
    """Samples with Illumina whole-genome data of sufficient depth and coverage, and a phenotype when given."""
    whole_genome = sequencing.where(
        (F.col("sequencing_platform") == "ILLUMINA") & (F.col("library_preparation_strategy") == "WGS")
    ).select("sample_id")
    covered = summary.where((F.col("median_depth") > min_depth) & (F.col("coverage_20x") > min_cov20))
    samples = covered.select("sample_id").join(whole_genome, "sample_id", "left_semi")
    if phenotype is not None:
        samples = samples.join(phenotype.select("sample_id"), "sample_id", "left_semi")
    return samples.distinct()


def phenotype_boxes(phenotype: DataFrame, samples: DataFrame, drug: DataFrame) -> DataFrame:
    """Fine category as ``box`` next to the coarse one: WHO, ALL, CC or CC-ATU."""
    fine = F.col("phenotypic_category")
    coarse = first_match(
        [
            (fine.isin("WHO_current", "non_WHO_CC_SR", "WHO_past"), F.lit("WHO")),
            (
                fine.isin("WHO_undefined", "non_WHO_CC_R", "non_WHO_CC_S", "CRyPTIC_MIC", "MYCOTB_MIC"),
                F.lit("ALL"),
            ),
            (fine.startswith("CC-ATU"), F.lit("CC-ATU")),
            (fine.startswith("CC"), F.lit("CC")),
        ],
        fine,
    )
    return (
        phenotype.join(samples.select("sample_id"), "sample_id", "left_semi")
        .join(drug.select("drug_id", "drug_name"), "drug_id")
        .select("sample_id", "drug_name", "phenotype", fine.alias("box"), coarse.alias("phenotypic_category"))
    )


def drug_overview(boxes: DataFrame, order: list[str] = rules.OVERVIEW_ORDER) -> DataFrame:
    """Distinct samples per drug, category and result, with ALL = WHO + not-WHO and the resistant share."""
    category = F.col("phenotypic_category")
    label = F.when(category == "ALL", F.lit("not-WHO")).otherwise(category)
    counts = (
        boxes.select("drug_name", label.alias("phenotypic_category"), "phenotype", "sample_id")
        .distinct()
        .groupBy("drug_name", "phenotypic_category")
        .agg(*[F.count_if(F.col("phenotype") == v).alias(v) for v in ("R", "S")])
    )
    subtotal = (
        counts.where(F.col("phenotypic_category").isin("WHO", "not-WHO"))
        .groupBy("drug_name")
        .agg(*[F.sum(v).alias(v) for v in ("R", "S")])
        .withColumn("phenotypic_category", F.lit("ALL"))
    )
    both = counts.unionByName(subtotal).withColumns(
        # An absent result has no count, hence no total and no share.
        {v: F.when(F.col(v) > 0, F.col(v)) for v in ("R", "S")}
    )
    both = both.withColumn("total", F.col("R") + F.col("S"))
    ranked = proportion_ci95(both, F.col("R"), F.col("total")).withColumnRenamed("percentage", "res_percentage")
    return ranked.orderBy("drug_name", priority(F.col("phenotypic_category"), order))


def samples_per_country(samples: DataFrame, sample: DataFrame, alias: DataFrame, country: DataFrame) -> DataFrame:
    """Distinct samples per country; the sample's own entry comes before its aliases'."""
    chosen = samples.select("sample_id").distinct()
    places = sample.select("sample_id", F.lit(0).alias("_source"), "country_id").unionByName(
        alias.select("sample_id", F.lit(1).alias("_source"), "country_id")
    )
    known = (
        places.where(F.col("country_id").isNotNull())
        .groupBy("sample_id")
        .agg(F.min(F.struct("_source", "country_id"))["country_id"].alias("country_id"))
    )
    names = country.select("three_letters_code", "country_usual_name")
    return (
        chosen.join(known, "sample_id", "left")
        .groupBy("country_id")
        .agg(F.count(F.lit(1)).alias("total"))
        .join(names, F.col("country_id") == F.col("three_letters_code"), "left")
        .groupBy("country_usual_name", "three_letters_code")
        .agg(F.sum("total").alias("total"))
    )


def sample_identifiers(samples: DataFrame, alias: DataFrame, sequencing: DataFrame) -> DataFrame:
    """Alias names, file prefixes and library names of each sample as text.

    Each side is condensed before the join, so aliases and libraries do not multiply.
    """
    names = alias.groupBy("sample_id").agg(
        set_text(F.col("name"), ", ").alias("names"), set_text(F.col("fastq_prefix"), ", ").alias("fastq_prefixes")
    )
    libraries = sequencing.groupBy("sample_id").agg(set_text(F.col("library_name"), ", ").alias("library_names"))
    joined = samples.select("sample_id").distinct().join(names, "sample_id", "left").join(libraries, "sample_id", "left")
    return joined.na.fill("", ["names", "fastq_prefixes", "library_names"])


def categorised_genotypes(
    genotype: DataFrame, categories: DataFrame, samples: DataFrame, min_af: float = rules.MIN_FRACTION
) -> DataFrame:
    """Calls of the cohort with their category and allele fraction."""
    return (
        genotype.where(F.col("genotyper").isin(*rules.CALLERS))
        .withColumn("af", allele_fraction())
        .where(F.col("af") >= min_af)
        .select("sample_id", "variant_id", "quality", "af")
        .join(samples.select("sample_id"), "sample_id", "left_semi")
        .join(categories, "variant_id")
    )


def _uncovered(sample_drug: DataFrame, genotypes: DataFrame, locus_stats: DataFrame, tier: DataFrame) -> DataFrame:
    """(sample, gene, drug, tier) whose gene is not fully covered although no deletion explains it."""
    deleted = (
        genotypes.where(F.col("predicted_effect").isin(rules.DELETION_EFFECTS))
        .select("sample_id", "gene_db_crossref_id")
        .distinct()
    )
    return (
        locus_stats.where(F.col("coverage_10x") < 1)
        .select("sample_id", "gene_db_crossref_id")
        .join(deleted, ["sample_id", "gene_db_crossref_id"], "left_anti")
        .join(tier.select("gene_db_crossref_id", "drug_id", "tier"), "gene_db_crossref_id")
        .join(sample_drug.select("sample_id", "drug_id"), ["sample_id", "drug_id"], "left_semi")
    )


def missing_tier_samples(
    sample_drug: DataFrame, genotypes: DataFrame, locus_stats: DataFrame, tier: DataFrame, drug: DataFrame
) -> DataFrame:
    missing = _uncovered(sample_drug, genotypes, locus_stats, tier).select("drug_id", "sample_id", "tier").distinct()
    return missing.join(drug.select("drug_id", "drug_name"), "drug_id").select("drug_name", "sample_id", "tier")


def genotype_extract(
    sample_drug: DataFrame,
    genotypes: DataFrame,
    positions: DataFrame,
    locus_stats: DataFrame,
    drug: DataFrame,
    symbol: DataFrame,
    tier: DataFrame,
    with_uncovered: bool = True,
) -> DataFrame:
    """Strongest call per (sample, drug, tier, gene, category), plus rows without category for uncovered genes."""
    keys = ["sample_id", "drug_id", "tier", "gene_db_crossref_id", "variant_category"]
    extract = (
        genotypes.join(sample_drug.select("sample_id", "drug_id"), ["sample_id", "drug_id"], "left_semi")
        .groupBy(*keys)
        .agg(F.max("af").alias("max_af"), F.max("quality").alias("max_quality"))
    )
    if with_uncovered:
        uncovered = _uncovered(sample_drug, genotypes, locus_stats, tier)
        extract = extract.unionByName(uncovered, allowMissingColumns=True)
    return (
        extract.join(positions, ["gene_db_crossref_id", "variant_category"], "left")
        .join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(symbol, "gene_db_crossref_id")
        .select(
            "drug_name",
            "sample_id",
            "tier",
            "resolved_symbol",
            "variant_category",
            "predicted_effect",
            F.lit(None).cast("string").alias("neutral"),
            "max_af",
            "max_quality",
            "position",
        )
    )


def match_previous_catalogue(
    info: DataFrame, variant: DataFrame, categories: DataFrame, symbol: DataFrame
) -> DataFrame:
    """Variants of an earlier catalogue, found by their alleles, under their present category."""
    alleles = ["position", "reference_nucleotide", "alternative_nucleotide"]
    return (
        info.select(*alleles, F.col("v1_annotation").alias("description"))
        .join(variant.select("variant_id", *alleles), alleles)
        .join(categories.drop("position"), "variant_id")
        .join(symbol, "gene_db_crossref_id")
        .select("resolved_symbol", "variant_category", "predicted_effect", "description")
        .distinct()
    )


def match_previous_grades(
    grade: DataFrame, categories: DataFrame, drug: DataFrame, symbol: DataFrame, version: int = 2
) -> DataFrame:
    """Graded variants under their present catalogue name."""
    return (
        grade.where(F.col("grade_version") == version)
        .select("variant_id", "drug_id", "grade")
        .join(categories.select("variant_id", "gene_db_crossref_id", "variant_category"), "variant_id")
        .join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(symbol, "gene_db_crossref_id")
        .select(F.concat_ws("_", "resolved_symbol", "variant_category").alias("variant"), "drug_name", "grade")
    )


def single_drug_categories(
    fapg: DataFrame, mnv: DataFrame, symbol: DataFrame, tier: DataFrame, drug: DataFrame, drug_name: str,
    max_upstream: int = 200,
) -> DataFrame:
    """Category names for one drug, loss of function pooled; ``lof`` before ``c.`` before the rest."""
    genes = tier.join(drug.where(F.col("drug_name") == drug_name).select("drug_id"), "drug_id", "left_semi").select(
        "gene_db_crossref_id", "tier"
    )
    effect = F.col("predicted_effect")
    upstream = effect == "upstream_gene_variant"
    parts = fapg.select(
        F.col("variant_id").alias("part_variant"),
        F.col("gene_db_crossref_id").alias("part_gene"),
        F.col("nucleotidic_annotation").alias("part_annotation"),
    )
    rows = (
        fapg.where(~effect.isin("downstream_gene_variant", "synonymous_variant"))
        .where(~(upstream & (F.col("distance_to_reference") > max_upstream)))
        .join(genes, "gene_db_crossref_id")
        .join(symbol, "gene_db_crossref_id")
        .join(mnv, (F.col("variant_id") == F.col("mnv_id")) & upstream, "left")
        .join(
            parts,
            (F.col("snv_id") == F.col("part_variant")) & (F.col("gene_db_crossref_id") == F.col("part_gene")),
            "left",
        )
    )
    category = first_match(
        [
            (effect.rlike("frameshift|stop_gained|start_lost"), F.lit("lof")),
            (effect.contains("stop_lost"), F.lit("stop_lost")),
            (upstream, F.coalesce("part_annotation", "nucleotidic_annotation")),
        ],
        F.col("proteic_annotation"),
    )
    rank = first_match(
        [(F.col("category") == "lof", F.lit(1)), (F.col("category").startswith("c."), F.lit(2))], F.lit(3)
    )
    return best_ranked(rows.withColumn("category", category), ["variant_id"], rank).select(
        "variant_id", F.concat_ws("_", "resolved_symbol", "category").alias("final_category"), "tier"
    )


def single_drug_extract(
    samples: DataFrame, genotype: DataFrame, categories: DataFrame, min_quality: float = 100
) -> DataFrame:
    """Phenotyped samples of one drug with their strongest call per category; samples without calls stay."""
    calls = (
        genotype.where((F.col("genotyper") == "freebayes") & (F.col("quality") > min_quality))
        .select("sample_id", "variant_id", allele_fraction().alias("af"))
        .join(samples.select("sample_id"), "sample_id", "left_semi")
        .join(categories, "variant_id")
        .groupBy("sample_id", "tier", "final_category")
        .agg(F.max("af").alias("max_percent_reads"))
    )
    return samples.select("sample_id", "phenotype").distinct().join(calls, "sample_id", "left")
