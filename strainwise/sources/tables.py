"""Readers: catalogue tables, delimited files, feature files, reports and submission sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainwise import rules


def scan_table(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """A catalogue table by name, or the parquet table ``name`` below ``root``."""
    return spark.table(name) if root is None else spark.read.parquet(f"{root}/{name}.parquet")


def scan_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, split: dict | None = None) -> DataFrame:
    """A database table or view.

    ``split`` (``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``)
    lets the executors read in parallel instead of through one connection.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    return reader.options(**(split or {})).load()


def jdbc_options(query: str, split: dict | None = None) -> dict:
    """Options for a query the database runs.  With ``split`` (as in :func:`scan_jdbc_table`) the query becomes a derived table, which every
    connection reads one range of."""
    return {"query": query} if not split else {"dbtable": f"({query}) t", **split}


def scan_jdbc_query(spark: SparkSession, url: str, query: str, properties: dict, split: dict | None = None) -> DataFrame:
    """The result of a query the database runs, read in parallel where a ``split`` is given."""
    return spark.read.format("jdbc").options(url=url, **properties, **jdbc_options(query, split)).load()


def scan_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", header: bool = False, missing: str | None = None
) -> DataFrame:
    """Delimited text with a declared header; compressed files are read as they are."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    if missing is not None:
        reader = reader.option("nullValue", missing)
    return reader.csv(path)


def scan_typed_text(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Typed import of result tables; ``NA`` is missing."""
    return scan_delimited(spark, path, schema, sep=sep, header=True, missing="NA")


def scan_keyless_tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated text without header; columns are strings called ``names``."""
    return scan_delimited(spark, path, ", ".join(f"`{name}` string" for name in names), sep="\t")


def parse_gff(lines: DataFrame, value: str = "value") -> DataFrame:
    """Feature lines (GFF3 ``key=value`` or GTF ``key "value"``) into typed columns and an attribute map."""
    part = F.split(F.col(value), "\t")
    # A feature line without nine columns is an error, not a line to skip.
    refused = F.raise_error(F.concat(F.lit("not a feature line: "), F.col(value))).cast("boolean")
    whole = F.when(F.size(part) == 9, F.lit(True)).otherwise(refused)
    attributes = F.regexp_replace(F.regexp_replace(part[8], r'\s*;\s*$', ""), r'\s*;\s*', ";")
    attributes = F.regexp_replace(F.regexp_replace(attributes, r'(^|;)([^=; ]+) "', "$1$2="), '"', "")
    return (
        lines.where(~F.col(value).startswith("#") & (F.trim(F.col(value)) != "")).where(whole)
        .select(
            part[0].alias("contig"),
            part[2].alias("feature"),
            part[3].try_cast("long").alias("start"),
            part[4].try_cast("long").alias("end"),
            part[6].alias("strand"),
            F.expr("map_from_arrays(array(), array())").cast("map<string,string>").alias("_empty"),
            attributes.alias("_attributes"),
        )
        .select(
            "contig",
            "feature",
            "start",
            "end",
            "strand",
            F.when(F.col("_attributes") == ".", F.col("_empty"))
            .otherwise(F.str_to_map("_attributes", F.lit(";"), F.lit("=")))
            .alias("attributes"),
        )
    )


def scan_gff_gtf(spark: SparkSession, path: str) -> DataFrame:
    return parse_gff(spark.read.text(path))


def parse_report(lines: DataFrame, key: str = "sample_id", value: str = "value") -> DataFrame:
    """``SN <name>: <number> # comment`` report lines into (key, name, number)."""
    pattern = r"^SN\s+([^:]+):\s*([^#]*)"
    return lines.where(F.col(value).startswith("SN")).select(
        key,
        F.trim(F.regexp_extract(value, pattern, 1)).alias("name"),
        F.trim(F.regexp_extract(value, pattern, 2)).try_cast("double").alias("number"),
    )


def scan_report_kv(spark: SparkSession, path: str) -> DataFrame:
    """Alignment reports, one file per sample; the sample is the file name up to the first ``-``."""
    lines = spark.read.text(path).withColumn(
        "sample_id", F.regexp_extract(F.input_file_name(), r"([^/]+?)-[^/]*$", 1)
    )
    return parse_report(lines)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return rules.rule_frame(spark, rows, schema)


def scan_submission_sheets(spark: SparkSession, root: str, sheets: tuple[str, ...] = ("general", "pDST", "MIC")) -> dict:
    """Submission sheets exported as one CSV folder per sheet; every column is text."""
    return {
        sheet: spark.read.option("header", True).option("inferSchema", False).csv(f"{root}/{sheet}") for sheet in sheets
    }
