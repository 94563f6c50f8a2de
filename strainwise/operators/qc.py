"""Sequencing quality summaries and the choice of samples to work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strainwise import rules, schemas
from strainwise.functions.numeric import ratio
from strainwise.functions.text import first_match

THRESHOLDS = {"10X": "coverage_10x", "15X": "coverage_15x", "20X": "coverage_20x", "30X": "coverage_30x"}


def weighted_median(regions: DataFrame) -> DataFrame:
    """Length-weighted median depth per sample.

    With regions in order of depth (then start), the value is that of the region just
    before the cumulated length passes one half, or of the first region.  Regions of
    equal depth are summed before any exchange, keeping the length of their first one,
    so the ordered pass sees one row per sample and depth.
    """
    length = F.col("end") - F.col("start")
    depths = regions.groupBy("sample_id", "depth").agg(
        F.sum(length).alias("length"), F.min(F.struct("start", length.alias("first"))).alias("_first")
    )
    ordered = Window.partitionBy("sample_id").orderBy("depth")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("sample_id")
    steps = depths.select(
        "sample_id",
        "depth",
        "length",
        F.col("_first.first").alias("first"),
        F.sum("length").over(running).alias("reached"),
        F.sum("length").over(whole).alias("total"),
        F.lag("depth").over(ordered).alias("before"),
    )
    passes_at_once = 2 * (F.col("reached") - F.col("length") + F.col("first")) > F.col("total")
    value = F.when(passes_at_once, F.coalesce("before", "depth")).otherwise(F.col("depth"))
    return (
        steps.where(2 * F.col("reached") > F.col("total"))
        .groupBy("sample_id")
        .agg(F.min(F.struct("depth", value.alias("value")))["value"].alias("median_depth"))
    )


def cumulative_share(regions: DataFrame) -> DataFrame:
    """Running share of the length per sample in order of depth, one row per depth."""
    depths = regions.groupBy("sample_id", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("length"))
    running = Window.partitionBy("sample_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("sample_id")
    return depths.select(
        "sample_id", "depth", ratio(F.sum("length").over(running), F.sum("length").over(whole)).alias("share")
    )


def coverage_fractions(thresholds: DataFrame) -> DataFrame:
    """Share of the genome at each depth per sample."""
    span = F.sum(F.col("end") - F.col("start"))
    return thresholds.groupBy("sample_id").agg(
        *[ratio(F.sum(column), span).alias(name) for column, name in THRESHOLDS.items()]
    )


def sample_depth_summary(regions: DataFrame, thresholds: DataFrame) -> DataFrame:
    return weighted_median(regions).join(coverage_fractions(thresholds), "sample_id")


def global_stats_rows(summary: DataFrame, report: DataFrame) -> DataFrame:
    """Depth summary and alignment report values, one row per sample, in file order."""
    values = report.groupBy("sample_id").agg(
        *[
            F.max(F.when(F.col("name") == label, F.col("number"))).cast(kind).alias(schemas.snake(name))
            for label, name, kind in schemas.REPORT_COLUMNS
        ]
    )
    rounded = {name: F.round(name, 4) for name in THRESHOLDS.values()}
    names = [schemas.snake(name) for name in schemas.DEPTH_COLUMNS]
    return (
        summary.withColumns(rounded)
        .join(values, "sample_id")
        .select("sample_id", *names, *[schemas.snake(name) for _, name, _ in schemas.REPORT_COLUMNS])
    )


def locus_stats_rows(regions: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Mean depth and covered shares per sample and locus."""
    span = F.col("end") - F.col("start")
    shares = thresholds.select(
        "sample_id", "locus", *[ratio(F.col(column), span).alias(name) for column, name in THRESHOLDS.items()]
    )
    return regions.select("sample_id", "locus", F.col("depth").alias("mean_depth")).join(
        shares, ["sample_id", "locus"], "left"
    )


def taxonomy_rows(report: DataFrame) -> DataFrame:
    return report.select("sample_id", "ncbi_taxon_id", F.col("percent").alias("value"))


# ------------------------------------------------------------------ work selection
def samples_to_process(
    sample: DataFrame, sequencing: DataFrame, phenotype: DataFrame, mic: DataFrame
) -> DataFrame:
    """Samples without status that have suitable sequencing data and a published test."""
    suitable = sequencing.where(
        (F.col("sequencing_platform") == "ILLUMINA")
        & (F.col("library_layout") == "PAIRED")
        & (F.col("library_preparation_strategy") == "WGS")
    ).select(F.col("sample_id").alias("id"))
    tested = (
        phenotype.where(~F.col("staging"))
        .select("sample_id")
        .unionByName(mic.where(~F.col("staging")).select("sample_id"))
        .select(F.col("sample_id").alias("id"))
    )
    return (
        sample.where(F.col("bioanalysis_status").isNull())
        .select("id")
        .join(suitable, "id", "left_semi")
        .join(tested, "id", "left_semi")
        .distinct()
    )


def next_batch(sample: DataFrame, size: int = rules.BATCH_SIZE, status: str = "Unprocessed") -> DataFrame:
    """The next ids to work on, lowest first."""
    waiting = sample.where(F.col("bioanalysis_status") == status).select("id").distinct()
    return waiting.orderBy("id").limit(size)


def ids_json(batch: DataFrame) -> DataFrame:
    """A bounded batch of ids as one JSON text."""
    ids = F.array_join(F.sort_array(F.collect_list("id")).cast("array<string>"), ",")
    return batch.agg(F.concat(F.lit('{"Ids":['), ids, F.lit("]}")).alias("ids"))


def _paired_illumina(sequencing: DataFrame) -> DataFrame:
    return sequencing.where((F.col("sequencing_platform") == "ILLUMINA") & (F.col("library_layout") == "PAIRED"))


def library_files(sequencing: DataFrame, hashed: DataFrame) -> DataFrame:
    """Libraries per sample with every verified file path of the sample and the kind of data."""
    paired = _paired_illumina(sequencing)
    verified = paired.join(
        hashed.select(F.col("sequencing_data_id").alias("id"), F.lit(True).alias("_hashed")).distinct(), "id", "left"
    ).where(F.col("_hashed") | (F.col("data_location") == "CNCB"))
    files = verified.groupBy("sample_id").agg(F.sort_array(F.collect_set("file_path")).alias("file_paths"))
    kind = first_match(
        [
            (F.col("library_preparation_strategy") == "WGS", F.lit("WGS")),
            (F.col("assay").isNotNull(), F.col("assay")),
        ],
        F.lit("drug_resistance_genes"),
    )
    return (
        paired.groupBy("sample_id", "data_location", "library_preparation_strategy", "assay")
        .agg(F.min("library_name").alias("library_name"))
        .select("sample_id", "library_name", "data_location", kind.alias("strategy"))
        .distinct()
        .join(files, "sample_id", "left")
    )


def library_count(sequencing: DataFrame) -> DataFrame:
    named = _paired_illumina(sequencing).where(F.col("library_name").isNotNull())
    return named.select("sample_id", "library_name").distinct().groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("libraries")
    )
