"""Fixed schemas of the files and tables, as Spark DDL text."""

from __future__ import annotations

import re

from pyspark.sql.types import StructType

# Headerless delimited files (fixed values: column order of the producing tools).
RAW_GENOTYPE = (
    "genotyper string, sampleid long, chrom string, pos long, id string, ref string, alt string, "
    "qual string, refad long, altad long, totaldp long, value string"
)
RAW_DELETION = (
    "sampleid long, chromosome string, position long, alternativenucleotide string, deletion string, "
    "genotyper string, quality long, dr long, rr long, dv long, rv long, value string"
)
RAW_LOCUS_STATS = (
    "sampleid long, locustagname string, meandepth double, cov10x double, cov15x double, cov20x double, cov30x double"
)
RAW_TAXONOMY = "sampleid long, ncbitaxonid long, value double"

# Alignment report: name in the report -> column of the global statistics, in file order (fixed values).
REPORT_COLUMNS = [
    ("raw total sequences", "RawTotalSequences", "long"),
    ("filtered sequences", "FilteredSequences", "long"),
    ("sequences", "Sequences", "long"),
    ("is sorted", "IsSorted", "long"),
    ("1st fragments", "FirstFragments", "long"),
    ("last fragments", "LastFragments", "long"),
    ("reads mapped", "ReadsMapped", "long"),
    ("reads mapped and paired", "ReadsMappedAndPaired", "long"),
    ("reads unmapped", "ReadsUnmapped", "long"),
    ("reads properly paired", "ReadsProperlyPaired", "long"),
    ("reads paired", "ReadsPaired", "long"),
    ("reads duplicated", "ReadsDuplicated", "long"),
    ("reads MQ0", "ReadsMQ0", "long"),
    ("reads QC failed", "ReadsQCFailed", "long"),
    ("non-primary alignments", "NonPrimaryAlignments", "long"),
    ("supplementary alignments", "SupplementaryAlignments", "long"),
    ("total length", "TotalLength", "long"),
    ("total first fragment length", "TotalFirstFragmentLength", "long"),
    ("total last fragment length", "TotalLastFragmentLength", "long"),
    ("bases mapped", "BasesMapped", "long"),
    ("bases mapped (cigar)", "BasesMappedCigar", "long"),
    ("bases trimmed", "BasesTrimmed", "long"),
    ("bases duplicated", "BasesDuplicated", "long"),
    ("mismatches", "Mismatches", "long"),
    ("error rate", "ErrorRate", "double"),
    ("average length", "AverageLength", "double"),
    ("average first fragment length", "AverageFirstFragmentLength", "double"),
    ("average last fragment length", "AverageLastFragmentLength", "double"),
    ("maximum length", "MaximumLength", "long"),
    ("maximum first fragment length", "MaximumFirstFragmentLength", "long"),
    ("maximum last fragment length", "MaximumLastFragmentLength", "long"),
    ("average quality", "AverageQuality", "double"),
    ("insert size average", "InsertSizeAverage", "double"),
    ("insert size standard deviation", "InsertSizeStandardDeviation", "double"),
    ("inward oriented pairs", "InwardOrientedPairs", "long"),
    ("outward oriented pairs", "OutwardOrientedPairs", "long"),
    ("pairs with other orientation", "PairsWithOtherOrientation", "long"),
    ("pairs on different chromosomes", "PairsOnDifferentChromosomes", "long"),
    ("percentage of properly paired reads (%)", "PercentageOfProperlyPairedReads", "double"),
]
DEPTH_COLUMNS = ["MedianDepth", "Coverage10x", "Coverage15x", "Coverage20x", "Coverage30x"]


def snake(name: str) -> str:
    """``ReadsMappedAndPaired`` -> ``reads_mapped_and_paired``; ``Coverage10x`` -> ``coverage_10x``."""
    parts = re.sub(r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|(?<=[A-Za-z])(?=[0-9])", "_", name)
    return parts.lower()


RAW_GLOBAL_STATS = ", ".join(
    ["sampleid long"]
    + [f"{name.lower()} double" for name in DEPTH_COLUMNS]
    + [f"{name.lower()} {kind}" for _, name, kind in REPORT_COLUMNS]
)
GLOBAL_STATS_MAPPING = (
    [("sampleid", "sample_id", "int")]
    + [(name.lower(), snake(name), "double") for name in DEPTH_COLUMNS]
    + [(name.lower(), snake(name), kind) for _, name, kind in REPORT_COLUMNS]
)

GENOTYPE = (
    "sample_id int, variant_id int, genotyper string, quality double, reference_ad int, alternative_ad int, "
    "total_dp int, genotype_value string"
)
STAGED_GENOTYPE = (
    "sample_id int, chromosome string, position int, reference_nucleotide string, alternative_nucleotide string, "
    "total_dp int, quality double, alternative_ad int, reference_ad int, genotyper string, genotype_value string"
)
VARIANT = (
    "variant_id int, chromosome string, position int, reference_nucleotide string, alternative_nucleotide string"
)
PREDICTION = "sample_id int, drug_id int, version int, resistance_flag string, variant string"

# Result tables of the association study, NA for missing values.
VARIANT_RESULTS = (
    "ID int, ac_case int, ac_ctrl int, an_case int, an_ctrl int, af float, odds_ratio float, analysis_group string"
)
VARIANT_ANNOTATIONS = "ID int, `Variant ID` string, Consequence string, gene_id string, HGVSc string, HGVSp string"
GENE_RESULTS = "gene_id string, analysis_group string, susceptible_genotyped int, resistant_genotyped int"


def struct_type(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    """Column names of a DDL text without nested types."""
    return [part.split()[0] for part in ddl.split(", ")]
