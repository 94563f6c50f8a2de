"""Laboratory submission sheets to entries: general data, susceptibility results, MICs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions.intervals import NUMBER, canonical_interval, decimal_text, interval, point_decimal
from strainwise.operators.relational import previous_value

PDST_COLUMNS = ["strain_id", "dst_method", "method_lj", "drug", "concentration", "result"]
_CODE_WITH_NUMBER = rf"^([A-Z]{{3,4}}) \(?{NUMBER}\)?"
_CODE = "^[A-Z]{3,4}$"
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"


def _squeeze(column: Column) -> Column:
    return F.replace(column, F.lit(" "), F.lit(""))


def _wide_to_long(sheet: DataFrame, ids: list[str], columns: list[str], name: str) -> DataFrame:
    """Unpivot text columns; empty cells disappear."""
    typed = sheet.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in [*ids, *columns]])
    long = typed.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], name, "_cell")
    return long.where(F.col("_cell").isNotNull())


def parse_pdst_sheet(sheet: DataFrame) -> DataFrame:
    """R, S and I results in long form.

    A sheet is either long already (``Drug``, ``Result``) or has one column per drug:
    ``INH (CC)`` with cells like ``R(0.5)``, ``INH (0.2)`` or ``INH`` with plain results.
    """
    for optional in ("DST Method", "Method LJ", "Concentration"):
        if optional not in sheet.columns:
            sheet = sheet.withColumn(optional, F.lit(""))
    ids = ["Strain ID", "DST Method", "Method LJ"]

    def shaped(rows: DataFrame, drug: Column, concentration: Column, result: Column) -> DataFrame:
        label = F.replace(_squeeze(drug), F.lit("(CC)"), F.lit(""))
        return rows.select(
            *[F.coalesce(_squeeze(F.col(f"`{c}`").cast("string")), F.lit("")).alias(n) for c, n in zip(ids, PDST_COLUMNS)],
            label.alias("drug"),
            F.coalesce(concentration.cast("string"), F.lit("")).alias("concentration"),
            result.alias("result"),
        ).where(F.col("result").isin("R", "S", "I"))

    if {"Drug", "Result"} <= set(sheet.columns):
        return shaped(sheet, F.col("Drug"), F.col("Concentration"), F.col("Result"))

    tables = []
    critical = [c for c in sheet.columns if "(CC)" in c]
    if critical:
        rows = _wide_to_long(sheet, ids, critical, "_drug")
        cell = _squeeze(F.col("_cell"))
        pattern = rf"^([RSI])\({NUMBER}\)"
        tables.append(
            shaped(
                rows,
                F.col("_drug"),
                point_decimal(F.regexp_extract(cell, pattern, 2)),
                F.regexp_extract(cell, pattern, 1),
            )
        )
    numbered = [c for c in sheet.columns if re.match(_CODE_WITH_NUMBER, c.strip())]
    if numbered:
        rows = _wide_to_long(sheet, ids, numbered, "_drug")
        header = F.trim("_drug")
        tables.append(
            shaped(
                rows,
                F.regexp_extract(header, _CODE_WITH_NUMBER, 1),
                point_decimal(F.regexp_extract(header, _CODE_WITH_NUMBER, 2)),
                F.trim("_cell"),
            )
        )
    bare = [c for c in sheet.columns if re.match(_CODE, c.strip())]
    if bare:
        rows = _wide_to_long(sheet, ids, bare, "_drug")
        tables.append(shaped(rows, F.trim("_drug"), F.lit(""), F.trim("_cell")))
    if not tables:
        return shaped(sheet, F.lit(""), F.lit(""), F.lit(""))
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


def parse_mic_sheet(sheet: DataFrame, infer_range: bool = False) -> DataFrame:
    """MIC entries as intervals from a long (``Drug``, ``Value``) or wide sheet.

    A plain number starts at the next lower number seen for its plate and drug with
    ``infer_range``, else at half its value.
    """
    if {"Drug", "Value"} <= set(sheet.columns):
        rows = sheet.select(
            F.col("`Strain ID`").alias("strain_id"), F.col("Plate").alias("plate"), F.col("Drug").alias("drug"),
            F.col("Value").cast("string").alias("_cell"),
        )
    else:
        drugs = [c for c in sheet.columns if re.match("[A-Z]{3,4}", c.strip())]
        rows = _wide_to_long(sheet, ["Strain ID", "Plate"], drugs, "drug").withColumnsRenamed(
            {"Strain ID": "strain_id", "Plate": "plate"}
        )
    rows = rows.select("strain_id", "plate", "drug", _squeeze(F.col("_cell")).alias("value"))
    if not infer_range:
        return rows.withColumn("mic_value", canonical_interval(F.col("value"), halve_points=True))

    bare = point_decimal(F.regexp_replace("value", "[≤≥<>=]+", ""))
    rows = rows.withColumn("_number", bare.try_cast("double"))
    steps = previous_value(
        rows.where(F.col("_number").isNotNull()), ["plate", "drug"], "_number", "_lower"
    )
    plain = point_decimal(F.col("value")).rlike(_PLAIN)
    inferred = interval(F.col("_lower").cast("string"), decimal_text(F.col("value")))
    return (
        rows.join(steps, ["plate", "drug", "_number"], "left")
        .withColumn("mic_value", F.when(plain, inferred).otherwise(canonical_interval(F.col("value"))))
        .select("strain_id", "plate", "drug", "value", "mic_value")
    )


def parse_general_sheet(sheet: DataFrame, countries: DataFrame, submission_date: str) -> DataFrame:
    """Sample entries: gaps filled within the strain, sampling range, numeric country code.

    ``countries`` has alpha2, alpha3, country_code.  Among several values of a strain
    the smallest fills the gaps; of several countries with one code, the smallest number counts.
    """
    names = set(sheet.columns)
    rows = sheet.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in sheet.columns])

    gaps = [c for c in ("Sampling date", "Year of isolation", "Sample type", "Country origin") if c in names]
    if gaps:
        # One aggregation and one join fill all columns: their gaps do not depend on each other.
        rows = rows.withColumns({c: F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) for c in gaps})
        first = rows.groupBy("Strain ID").agg(*[F.min(f"`{c}`").alias(f"_first {c}") for c in gaps])
        rows = rows.join(first, "Strain ID", "left").withColumns({c: F.coalesce(f"`{c}`", f"`_first {c}`") for c in gaps})
    if "Sampling date" in names:
        day = F.col("`Sampling date`")
        sampling = F.concat(F.lit("["), day, F.lit(","), day, F.lit("]"))
    elif "Year of isolation" in names:
        year = F.col("`Year of isolation`").try_cast("int").cast("string")
        sampling = F.concat(F.lit("["), year, F.lit("-01-01,"), year, F.lit("-12-31]"))
    else:
        sampling = F.lit(None).cast("string")
    origin = F.upper(F.col("`Country origin`")) if "Country origin" in names else F.lit(None).cast("string")
    rows = rows.select(
        F.col("`Strain ID`").alias("sample_name"),
        (F.col("LABNO") if "LABNO" in names else F.col("`Strain ID`")).alias("labno"),
        F.when(~sampling.isin(rules.NO_DATE_RANGES), sampling).alias("sampling_date"),
        F.lit(submission_date).cast("date").alias("submission_date"),
        (F.col("`Sample type`") if "Sample type" in names else F.lit(None).cast("string")).alias("isolation_source"),
        origin.alias("_origin"),
    )
    codes = (
        countries.select(F.explode(F.array("alpha2", "alpha3")).alias("_origin"), "country_code")
        .where(F.col("_origin").isNotNull())
        .groupBy("_origin").agg(F.min("country_code").alias("country_code"))
    )
    numeric = F.when(F.col("_origin").rlike("^[0-9]{3}"), F.col("_origin").try_cast("int"))
    return (
        rows.join(codes, "_origin", "left")
        .withColumn("country_code", F.coalesce(F.col("country_code").cast("int"), numeric))
        .drop("_origin")
        .distinct()
    )


def _hash_pairs(files: DataFrame, owner: str) -> DataFrame:
    """Every ordered pair of distinct hashes of an owner's files, of which an owner has a handful."""
    hashes = files.groupBy(owner).agg(F.array_sort(F.collect_set("md5")).alias("_all"))
    first = hashes.select(owner, "_all", F.explode("_all").alias("_first"))
    return first.select(owner, "_first", F.explode("_all").alias("_second")).where("_first < _second")


def detect_resubmissions(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """Strains whose files are those of an existing sample: exactly two file hashes in common.

    ``entries`` has strain_id, md5; ``existing`` has sample_name, md5.  Both sides are matched on pairs of their own hashes, so
    one hash that very many have (of an empty file) brings nobody together; exactly two in common is exactly one pair.  Hashes that no
    existing sample has go before pairs are made of them: their number grows with the square of the files of a strain.
    """
    known = entries.join(existing.select("md5"), "md5", "left_semi")
    return (
        _hash_pairs(known, "strain_id")
        .join(_hash_pairs(existing, "sample_name"), ["_first", "_second"])
        .groupBy("strain_id", "sample_name")
        .agg(F.count(F.lit(1)).alias("_shared"))
        .where("_shared = 1")
        .groupBy("strain_id")
        .agg(F.min("sample_name").alias("sample_name"))
    )


def replace_resubmitted(df: DataFrame, replacements: DataFrame, column: str = "strain_id") -> DataFrame:
    """Put the existing sample name where a strain was submitted before."""
    names = replacements.select(F.col("strain_id").alias("_old"), F.col("sample_name").alias("_new"))
    return (
        df.join(names, F.col(column) == F.col("_old"), "left")
        .withColumn(column, F.coalesce("_new", column))
        .drop("_old", "_new")
    )


def resubmission_aliases(replacements: DataFrame, sample: DataFrame) -> DataFrame:
    """The submitted names of resubmitted strains as aliases of the existing sample."""
    return replacements.join(sample.select("sample_name", "sample_id"), "sample_name").select(
        "sample_id",
        F.lit("Additional sequencing name").alias("db"),
        F.lit("Sample name").alias("db_label"),
        F.col("strain_id").alias("sample_name_synonym"),
    )
