"""Predictive values of variant categories and the search for neutral ones."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions.numeric import allele_fraction, clopper_pearson_upper, critical_susceptible, ratio
from strainwise.operators.relational import rename_with_suffix, top1_per_group
from strainwise.session import cut_lineage

CATEGORY_KEY = ["drug_id", "tier", "gene_db_crossref_id", "variant_category"]
MEASURES = ["R", "S", "PPV", "Upper_PPV"]


def phenotype_counts(genotypes: DataFrame, values: list[str] = ("R", "S")) -> DataFrame:
    """Distinct samples per category and result.

    Repeated calls are removed first, on (category, result, sample): the exchange is
    keyed by sample too, so a category found in most samples is no hot key.
    """
    calls = genotypes.select(*CATEGORY_KEY, "phenotype", "sample_id").distinct()
    return calls.groupBy(*CATEGORY_KEY).agg(*[F.count_if(F.col("phenotype") == v).alias(v) for v in values])


def ppv(counts: DataFrame) -> DataFrame:
    """Positive predictive value and its upper bound; the counts are read once."""
    return counts.withColumn("PPV", ratio(F.col("R"), F.col("R") + F.col("S"))).withColumn(
        "Upper_PPV", clopper_pearson_upper(F.col("R"), F.col("S"))
    )


def neutral_below(values: DataFrame, threshold: float, label: str) -> DataFrame:
    """Categories whose upper bound lies below the threshold, where the bound has been worked out."""
    return values.where(F.col("Upper_PPV") < threshold).drop("R", "S").withColumn("set", F.lit(label))


def critical_steps(counts: DataFrame, threshold: float) -> DataFrame:
    """(R, least_S): the step table of the threshold, a row for every R that occurs.

    From a count S of ``least_S`` on, the upper bound of R / (R + S) is below the threshold.  ``least_S`` never falls with R, so categories are
    decided by comparing two numbers; the bound itself is not needed.
    """

    @F.pandas_udf("long")
    def least(resistant: pd.Series) -> pd.Series:
        return pd.Series(critical_susceptible(resistant.to_numpy(float), threshold))

    return counts.select("R").distinct().withColumn("least_S", least("R"))


def neutral_by_counts(counts: DataFrame, threshold: float, label: str) -> DataFrame:
    """Categories below the threshold, from their counts alone: they meet the step table on R, which holds every R once."""
    steps = cut_lineage(critical_steps(counts, threshold))
    return counts.join(steps, "R").where("S >= least_S").select(*CATEGORY_KEY, F.lit(label).alias("set"))


def solo_samples(genotypes: DataFrame) -> DataFrame:
    """(sample, drug) with exactly one category in tier 1, or none there and one in tier 2, and that tier."""
    distinct = genotypes.select("sample_id", "drug_id", "tier", "gene_db_crossref_id", "variant_category").distinct()
    counts = distinct.groupBy("sample_id", "drug_id").agg(
        F.count_if(F.col("tier") == 1).alias("_first"), F.count_if(F.col("tier") == 2).alias("_second")
    )
    return counts.where("_first = 1 or (_first = 0 and _second = 1)").select(
        "sample_id", "drug_id", F.when(F.col("_first") == 1, 1).otherwise(2).alias("tier")
    )


def modal_position(genotypes: DataFrame) -> DataFrame:
    """Most frequent (position, effect) of each category by distinct samples; lower position, then effect, wins ties."""
    place = ["gene_db_crossref_id", "variant_category", "position", "predicted_effect"]
    counts = genotypes.select(*place, "sample_id").distinct().groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    best = top1_per_group(
        counts,
        place[:2],
        [-F.col("n"), F.col("position"), F.col("predicted_effect")],
        ["position", "predicted_effect"],
    )
    return best.withColumnsRenamed({"position": "ModalPosition", "predicted_effect": "Effect"})


def genotypes_for_neutral(
    genotype: DataFrame,
    samples: DataFrame,
    categories: DataFrame,
    min_quality: float = rules.MIN_QUALITY_NEUTRAL,
    min_af: float = rules.CLEAR_FRACTION,
) -> DataFrame:
    """High-quality, clear calls of the cohort with their categories."""
    return (
        genotype.where(F.col("genotyper").isin(*rules.CALLERS) & (F.col("quality") > min_quality))
        .withColumn("percent_reads", allele_fraction())
        .where(F.col("percent_reads") > min_af)
        .select("sample_id", "variant_id", "percent_reads")
        .join(samples.select("sample_id"), "sample_id", "left_semi")
        .join(categories, "variant_id")
    )


def known_marker_samples(genotypes: DataFrame, drug: DataFrame, gene: DataFrame) -> DataFrame:
    """(sample, drug) that hold a known resistance marker, by the rule table."""
    markers = rules.known_marker_frame(genotypes.sparkSession)
    rule = markers.join(drug.select("drug_id", "drug_name"), "drug_name").join(
        gene.select("gene_db_crossref_id", "gene_symbol"), "gene_symbol"
    )
    in_range = (
        F.col("distance_to_reference").between(F.col("first_nt"), F.col("last_nt"))
        & (F.col("predicted_effect") != "synonymous_variant")
    )
    holds = (
        F.array_contains("changes", F.col("variant_category"))
        | F.coalesce(F.regexp_like("variant_category", F.col("pattern")), F.lit(False))
        | F.coalesce(in_range, F.lit(False))
    )
    # The rule is checked per category, of which there are few, before meeting the calls.
    seen = ["drug_id", "gene_db_crossref_id", "variant_category", "distance_to_reference", "predicted_effect"]
    marked = (
        genotypes.select(*seen)
        .distinct()
        .join(rule, ["drug_id", "gene_db_crossref_id"])
        .where(holds)
        .select(*seen)
        .distinct()
    )
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"g.{c}")) for c in seen]
    return genotypes.alias("g").join(marked.alias("m"), same, "left_semi").select("sample_id", "drug_id").distinct()


def _solo_ppv(calls: DataFrame, remaining: DataFrame, raw: DataFrame) -> DataFrame:
    """Predictive values from resistant samples whose only remaining category this is; S counts as in set A."""
    key = ["drug_id", "gene_db_crossref_id", "variant_category"]
    left = calls.join(remaining.select(*key), key, "left_semi")
    solo = solo_samples(left.where(F.col("phenotype") == "R"))
    resistant = phenotype_counts(left.join(solo, ["drug_id", "tier", "sample_id"], "left_semi"), ["R"])
    return ppv(resistant.join(raw.select(*CATEGORY_KEY, "S"), CATEGORY_KEY))


def neutral_variants(
    samples: DataFrame,
    phenotype: DataFrame,
    categories: DataFrame,
    genotype: DataFrame,
    drug: DataFrame,
    gene: DataFrame,
    listed_earlier: DataFrame,
    threshold: float = rules.NEUTRAL_THRESHOLD,
    min_quality: float = rules.MIN_QUALITY_NEUTRAL,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Neutral categories by set, the predictive values of every set, and modal positions.

    A: all calls.  B: without (sample, drug) holding a known marker.  D1: solo after
    A and B.  D2: solo after D1.  M: variants listed earlier, for four drugs.  The
    calls feed all sets, so they are written once as a checkpoint.
    """
    found = genotypes_for_neutral(genotype, samples, categories, min_quality)
    calls = cut_lineage(found.join(phenotype.select("sample_id", "drug_id", "phenotype"), ["sample_id", "drug_id"]))
    raw = cut_lineage(phenotype_counts(calls))
    values = {"A": cut_lineage(ppv(raw))}
    marked = known_marker_samples(calls, drug, gene)
    values["B"] = cut_lineage(ppv(phenotype_counts(calls.join(marked, ["sample_id", "drug_id"], "left_anti"))))
    neutral = {label: neutral_below(values[label], threshold, label) for label in ("A", "B")}

    remaining = categories.select(*CATEGORY_KEY).distinct()
    for label in ("A", "B"):
        remaining = remaining.join(neutral[label].select(*CATEGORY_KEY), CATEGORY_KEY, "left_anti")
    for label in ("D1", "D2"):
        values[label] = cut_lineage(_solo_ppv(calls, remaining, raw))
        neutral[label] = neutral_below(values[label], threshold, label)
        remaining = remaining.join(neutral[label].select(*CATEGORY_KEY), CATEGORY_KEY, "left_anti")

    four = drug.where(F.col("drug_name").isin(rules.LISTED_EARLIER_DRUGS)).select("drug_id")
    neutral["M"] = (
        categories.join(listed_earlier.select("variant_id"), "variant_id", "left_semi")
        .join(four, "drug_id", "left_semi")
        .join(remaining, CATEGORY_KEY, "left_semi")
        .select(*CATEGORY_KEY)
        .distinct()
        .withColumn("set", F.lit("M"))
    )
    wide = None
    for label, suffix in (("A", "_raw_setA"), ("B", "_WKME_setB"), ("D1", "_SOLO_setD1"), ("D2", "_SOLO_setD2")):
        part = rename_with_suffix(values[label], MEASURES, suffix)
        wide = part if wide is None else wide.join(part, CATEGORY_KEY, "left")
    all_neutral = neutral["A"]
    for label in ("B", "D1", "D2", "M"):
        all_neutral = all_neutral.unionByName(neutral[label], allowMissingColumns=True)
    return wide, all_neutral, modal_position(calls)


def neutral_report(
    table: DataFrame, drug: DataFrame, symbol: DataFrame, locus: DataFrame, positions: DataFrame
) -> DataFrame:
    """Either neutral table with drug, gene, locus and modal position instead of ids."""
    names = {
        "drug_name": "Drug",
        "resolved_symbol": "Gene",
        "rv_symbol": "LocusTag",
        "tier": "Tier",
        "variant_category": "Variant",
        "set": "Set",
    }
    return (
        table.join(drug.select("drug_id", "drug_name"), "drug_id")
        .join(symbol, "gene_db_crossref_id")
        .join(locus, "gene_db_crossref_id")
        .join(positions, ["gene_db_crossref_id", "variant_category"])
        .drop("drug_id", "gene_db_crossref_id")
        .withColumnsRenamed(names)
    )
