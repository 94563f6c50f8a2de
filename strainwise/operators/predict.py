"""Resistance prediction from rule tables: the first and the second rule set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions.numeric import allele_fraction, codon_of, ratio
from strainwise.functions.text import first_match, ordered_text
from strainwise.operators.relational import count_true_as_all, top1_per_group, with_each

PAIR = ["sample_id", "drug"]


# ------------------------------------------------------------------ first rule set
def rule_variants_v1(annotation: DataFrame) -> DataFrame:
    """Variants that count for a drug, with the flag of those that count only next to rifampicin resistance.

    ``annotation`` has variant_id, gene_name, predicted_effect, hgvs_value and the
    codon ``mii``.
    """
    spark = annotation.sparkSession
    accept = rules.accept_frame_v1(spark)
    change = F.col("hgvs_value")
    accepted = (
        (annotation["gene_name"] == accept["gene_name"])
        & ((F.col("effect_like") == "") | F.regexp_like("predicted_effect", F.col("effect_like")))
        & ((F.size("changes") == 0) | F.array_contains("changes", change))
        & ((F.size("refused") == 0) | ~F.array_contains("refused", change))
        & (F.col("first_codon").isNull() | F.col("mii").between(F.col("first_codon"), F.col("last_codon")))
    )
    gene_drugs = rules.rule_frame(spark, rules.GENE_DRUGS_V1, "gene_name string, _gene_drug string")
    change_drugs = rules.change_drug_frame_v1(spark).withColumnRenamed("drug", "_change_drug")
    only_with_rifampicin = (
        (F.col("gene_name") == "pncA")
        & (F.col("predicted_effect") != "upstream_gene_variant")
        & ~F.col("predicted_effect").rlike(rules.LOSS_PATTERN)
        & ~change.isin(rules.PNCA_DIRECT)
    )
    return (
        annotation.join(accept, accepted, "left_semi")
        .join(gene_drugs, "gene_name", "left")
        .join(change_drugs, ["gene_name", "hgvs_value"], "left")
        .select(
            "variant_id",
            F.coalesce("_gene_drug", "_change_drug").alias("drug"),
            F.coalesce(only_with_rifampicin, F.lit(False)).alias("with_rifampicin"),
            "gene_name",
            "hgvs_value",
        )
    )


def annotated_samples(
    package: DataFrame, alias: DataFrame, sample: DataFrame, sequencing: DataFrame, locus_stats: DataFrame
) -> DataFrame:
    """Annotated samples that have a packaged alias, sequencing data and locus statistics."""
    named = alias.where(F.col("name") != rules.EXCLUDED_SAMPLE_NAME).join(
        package.select(F.col("id").alias("package_id")), "package_id", "left_semi"
    )
    samples = sample.where(F.col("bioanalysis_status") == "Annotated").select(F.col("id").alias("sample_id"))
    for other in (named, sequencing, locus_stats):
        samples = samples.join(other.select("sample_id"), "sample_id", "left_semi")
    return samples.distinct()


def loss_by_coverage_v1(locus_stats: DataFrame, samples: DataFrame, gene_name: DataFrame) -> DataFrame:
    """Poorly covered genes whose loss makes resistant."""
    lost = rules.rule_frame(locus_stats.sparkSession, rules.COVERAGE_LOSS_V1, "gene_name string, drug string")
    return (
        locus_stats.where(F.col("coverage_10x") < rules.MIN_COVERAGE_10X)
        .join(gene_name.join(lost, "gene_name"), "gene_db_crossref_id")
        .join(samples, "sample_id", "left_semi")
        .select("sample_id", "drug", "coverage_10x", "gene_name", F.lit("deletion").alias("hgvs_value"))
    )


def genotypes_of_interest(genotype: DataFrame, samples: DataFrame, rule_variants: DataFrame) -> DataFrame:
    """Calls of rule variants; ribosomal calls need a majority of reads."""
    majority = ratio(F.col("alternative_ad"), F.col("total_dp")) > rules.MIN_FRACTION_RIBOSOMAL
    return (
        genotype.where(F.col("genotyper") == "freebayes")
        .select("sample_id", "variant_id", F.coalesce(majority, F.lit(False)).alias("_majority"))
        .join(samples, "sample_id", "left_semi")
        .join(rule_variants, "variant_id")
        .where((F.col("gene_name") != "rrs") | F.col("_majority"))
        .select("sample_id", "drug", "variant_id", "with_rifampicin", "gene_name", "hgvs_value")
    )


def uncovered_rrs(locus_stats: DataFrame, samples: DataFrame, gene_name: DataFrame) -> DataFrame:
    """(sample, drug) whose 16S gene cannot be judged, for the four drugs it decides on."""
    poor = (
        locus_stats.where(
            (F.col("coverage_10x") < rules.MIN_COVERAGE_10X) & (F.col("mean_depth") < rules.MIN_DEPTH)
        )
        .join(gene_name.where(F.col("gene_name") == "rrs"), "gene_db_crossref_id", "left_semi")
        .join(samples, "sample_id", "left_semi")
        .select("sample_id")
    )
    return with_each(poor, "drug", rules.UNCOVERED_RRS_DRUGS)


def predict_v1(
    samples: DataFrame, interest: DataFrame, loss: DataFrame, uncovered: DataFrame, drug: DataFrame
) -> DataFrame:
    """R, S or U per sample and drug, with the variants behind it.

    Pyrazinamide variants that count only next to rifampicin resistance are settled
    by carrying the sample's rifampicin result along, not by a self join of the result.
    """
    calls = interest.join(loss.select(*PAIR, F.col("gene_name").alias("lost_gene")), PAIR, "full")
    gene = F.coalesce("lost_gene", "gene_name")
    text = F.concat(gene, F.lit("_"), F.when(F.col("lost_gene").isNotNull(), "deletion").otherwise(F.col("hgvs_value")))
    lost = F.col("lost_gene").isNotNull()
    evidence = calls.groupBy(*PAIR).agg(
        (F.bool_or(F.coalesce(~F.col("with_rifampicin"), F.lit(False))) | F.bool_or(lost)).alias("resistant"),
        count_true_as_all(F.col("with_rifampicin")).alias("with_rifampicin"),
        ordered_text(gene, text, ";").alias("variant"),
    )
    rifampicin = evidence.where((F.col("drug") == "Rifampicin") & F.col("resistant")).select(
        "sample_id", F.lit(True).alias("rifampicin_resistant")
    )
    unknown = uncovered.select(*PAIR).distinct().withColumn("unknown", F.lit(True))
    companion = (
        (F.col("drug") == "Pyrazinamide")
        & F.coalesce("with_rifampicin", F.lit(False))
    )
    supported = F.coalesce("rifampicin_resistant", F.lit(False))
    flag = first_match(
        [
            (F.coalesce("resistant", F.lit(False)), F.lit("R")),
            (companion & supported, F.lit("R")),
            (F.coalesce("unknown", F.lit(False)), F.lit("U")),
        ],
        F.lit("S"),
    )
    return (
        with_each(samples.select("sample_id"), "drug", rules.DRUGS_V1)
        .join(evidence, PAIR, "left")
        .join(rifampicin, "sample_id", "left")
        .join(unknown, PAIR, "left")
        .join(drug.select("drug_id", F.col("drug_name").alias("drug")), "drug", "left")
        .select(
            "sample_id",
            "drug_id",
            F.lit(1).alias("version"),
            flag.alias("resistance_flag"),
            F.when(companion & ~supported, "").otherwise(F.coalesce("variant", F.lit(""))).alias("variant"),
        )
    )


# ------------------------------------------------------------------ second rule set
def min_grade_by_allele(grade: DataFrame, variant: DataFrame, version: int = 2) -> DataFrame:
    """Best grade per variant and drug, variants found by their alleles."""
    alleles = ["position", "reference_nucleotide", "alternative_nucleotide"]
    return (
        grade.where(F.col("grade_version") == version)
        .select(*alleles, "drug_id", "grade", "grade_version")
        .join(variant.select("variant_id", *alleles), alleles)
        .groupBy("variant_id", "drug_id", "grade_version")
        .agg(F.min("grade").alias("grade"))
    )


def named_categories(categories: DataFrame, symbol: DataFrame) -> DataFrame:
    """Categories with their catalogue name ``symbol_category``."""
    return (
        categories.drop("position")
        .join(symbol, "gene_db_crossref_id")
        .withColumn("variant_catalogue_name", F.concat_ws("_", "resolved_symbol", "variant_category"))
        .distinct()
    )


def _gene_drug_ids(drug: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    table = rules.rule_frame(drug.sparkSession, pairs, "resolved_symbol string, drug_name string")
    return table.join(drug.select("drug_id", "drug_name"), "drug_name").select("resolved_symbol", "drug_id")


def graded_variants(categories: DataFrame, grade: DataFrame, drug: DataFrame) -> DataFrame:
    """Variants with grade: listed 1-2, loss of function 2, epistasis 0, ungraded changes in the rpoB region 2."""
    columns = ["variant_id", "variant_catalogue_name", "drug_id", "grade"]
    listed = grade.where((F.col("grade_version") == 2) & F.col("grade").isin(1, 2))
    by_grade = categories.join(
        listed.select("variant_id", "drug_id", "grade"), ["variant_id", "drug_id"]
    ).select(*columns)

    loss = categories.where(F.col("predicted_effect").isin(rules.LOSS_EFFECTS))

    def by_rule(pairs: list[tuple[str, str]], value: int) -> DataFrame:
        genes = _gene_drug_ids(drug, pairs)
        return loss.join(genes, ["resolved_symbol", "drug_id"], "left_semi").withColumn("grade", F.lit(value))

    codon = codon_of(F.col("distance_to_reference"))
    region = (
        categories.where(
            (F.col("resolved_symbol") == "rpoB")
            & ~F.col("predicted_effect").isin("synonymous_variant", "upstream_gene_variant")
            & codon.between(*rules.RPOB_CODONS)
        )
        .join(listed.select("variant_id"), "variant_id", "left_anti")
        .withColumn("grade", F.lit(2))
    )
    return (
        by_grade.unionByName(by_rule(rules.LOSS_OF_FUNCTION_V2, 2).select(*columns))
        .unionByName(by_rule(rules.EPISTASIS_V2, 0).select(*columns))
        .unionByName(region.select(*columns))
        .distinct()
    )


def loss_by_coverage_v2(locus_stats: DataFrame, symbol: DataFrame, drug: DataFrame) -> DataFrame:
    genes = symbol.join(_gene_drug_ids(drug, rules.COVERAGE_LOSS_V2), "resolved_symbol")
    return (
        locus_stats.where(F.col("coverage_10x") < rules.MIN_COVERAGE_10X)
        .select("sample_id", "gene_db_crossref_id")
        .join(genes, "gene_db_crossref_id")
        .select(
            "sample_id",
            "drug_id",
            F.lit(1).alias("grade"),
            F.concat("resolved_symbol", F.lit("_deletion")).alias("variant_catalogue_name"),
        )
    )


def sample_grades(genotype: DataFrame, sample: DataFrame, graded: DataFrame, loss: DataFrame) -> DataFrame:
    """Graded calls per sample; a call below the clear fraction shows it; uncovered genes are added."""
    majority = ratio(F.col("alternative_ad"), F.col("total_dp")) > rules.MIN_FRACTION_RIBOSOMAL
    name = F.col("variant_catalogue_name")
    ribosomal = name.startswith(rules.RIBOSOMAL_PREFIXES[0]) | name.startswith(rules.RIBOSOMAL_PREFIXES[1])
    shown = F.when(
        F.col("af") < rules.CLEAR_FRACTION, F.concat(name, F.lit(" ("), F.col("af").cast("string"), F.lit(")"))
    ).otherwise(name)
    calls = (
        genotype.where(F.col("genotyper").isin(*rules.CALLERS))
        .select(
            "sample_id", "variant_id", allele_fraction().alias("af"),
            F.coalesce(majority, F.lit(False)).alias("_majority"),
        )
        .join(sample.select("sample_id"), "sample_id", "left_semi")
        .join(graded, "variant_id")
        .where(~ribosomal | F.col("_majority"))
        .select("sample_id", "drug_id", "grade", shown.alias("variant_catalogue_name"))
    )
    return calls.unionByName(loss)


def min_grade_mutations(grades: DataFrame) -> DataFrame:
    """Lowest grade per (sample, drug) with its mutations: only those of grade 0 when 0 is reached, else all.

    One aggregation yields both lists, so nothing is joined back.
    """
    name = F.col("variant_catalogue_name")
    return (
        grades.distinct()
        .groupBy("sample_id", "drug_id")
        .agg(
            F.min("grade").alias("grade"),
            F.collect_set(F.when(F.col("grade") == 0, name)).alias("_overruling"),
            F.collect_set(name).alias("_all"),
        )
        .select(
            "sample_id",
            "drug_id",
            "grade",
            F.concat_ws(
                "; ", F.sort_array(F.when(F.col("grade") == 0, F.col("_overruling")).otherwise(F.col("_all")))
            ).alias("mutation"),
        )
    )


def uncalled_genes(locus_stats: DataFrame, sample: DataFrame, symbol: DataFrame, drug: DataFrame) -> DataFrame:
    """(sample, drug) with a ribosomal gene too poorly covered to call."""
    genes = symbol.join(_gene_drug_ids(drug, rules.UNCALLABLE_V2), "resolved_symbol")
    return (
        locus_stats.where(
            (F.col("coverage_10x") < rules.MIN_COVERAGE_10X) & (F.col("mean_depth") < rules.MIN_DEPTH)
        )
        .select("sample_id", "gene_db_crossref_id")
        .join(genes, "gene_db_crossref_id")
        .join(sample.select("sample_id"), "sample_id", "left_semi")
        .select("sample_id", "drug_id")
        .distinct()
    )


def predict_v2(samples: DataFrame, mutations: DataFrame, uncalled: DataFrame, drug: DataFrame) -> DataFrame:
    """R, S or U per sample and drug from the lowest grade."""
    resistant = F.col("grade").isin(1, 2)
    return (
        with_each(samples.select("sample_id").distinct(), "drug_name", rules.DRUGS_V2)
        .join(drug.select("drug_id", "drug_name"), "drug_name")
        .join(mutations, ["sample_id", "drug_id"], "left")
        .join(uncalled.withColumn("_uncalled", F.lit(True)), ["sample_id", "drug_id"], "left")
        .select(
            "sample_id",
            "drug_id",
            F.lit(2).alias("version"),
            first_match([(resistant, F.lit("R")), (F.col("_uncalled"), F.lit("U"))], F.lit("S")).alias(
                "resistance_flag"
            ),
            F.when(F.col("grade").isin(0, 1, 2), F.col("mutation")).otherwise("").alias("variant"),
        )
    )


def prediction_export(
    prediction: DataFrame, sample: DataFrame, alias: DataFrame, drug: DataFrame, version: int = 2
) -> DataFrame:
    """Predictions of public samples under their first archive name, in order of prediction id."""
    named = alias.where((F.col("origin") == "BioSample") & (F.col("origin_label") == "Sample name"))
    first = top1_per_group(named, ["sample_id"], [F.col("id")], ["name"])
    public = sample.where(F.col("origin") == "NCBI").select(F.col("id").alias("sample_id"))
    return (
        prediction.where(
            F.col("drug_id").isin(rules.EXPORT_DRUG_IDS) & (F.coalesce("version", F.lit(1)) == version)
        )
        .join(public, "sample_id", "left_semi")
        .join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(first, "sample_id", "left")
        .orderBy("id")
        .select(F.col("name").alias("sample_aliases_name"), "drug_name", "resistance_flag", "variant")
    )
