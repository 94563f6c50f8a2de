"""From annotator text to normalised annotation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise.functions import hgvs
from strainwise.functions.text import blank_to_null, first_match
from strainwise.rules import ABLATIONS, ANNOTATION_FIELDS, DROPPED_EFFECTS, FLANKING_EFFECTS

NORMALISED = ["variant_id", "effect", "gene_id", "dist", "type", "value"]


def parse_effect_annotations(df: DataFrame, variant_id: str = "variant_id", text: str = "annotation") -> DataFrame:
    """``ANN=`` text to one typed row per entry; an entry without 16 fields stops the job."""
    entry = F.explode(F.split(F.substring_index(text, ";", 1), ","))
    parts = F.split("_entry", r"\|", -1)
    checked = F.when(F.size(parts) == len(ANNOTATION_FIELDS), parts).otherwise(
        F.raise_error(F.concat(F.lit("annotation entry without 16 fields: "), F.col("_entry")))
    )
    rows = df.select(F.col(variant_id).alias("variant_id"), entry.alias("_entry")).select(
        "variant_id", checked.alias("_parts")
    )
    columns = {name: F.col("_parts")[i] for i, name in enumerate(ANNOTATION_FIELDS)}
    columns["allele"] = F.replace(columns["allele"], F.lit("ANN="), F.lit(""))
    columns["gene_id"] = F.replace(columns["gene_id"], F.lit("gene-"), F.lit(""))
    for name in ("cds_len", "protein_len"):
        columns[name] = F.substring_index(columns[name], "/", 1)
    return rows.select("variant_id", *[column.alias(name) for name, column in columns.items()])


def fix_stop_retained(df: DataFrame) -> DataFrame:
    """Stop-retained calls whose protein text says otherwise: early stop, or plain missense."""
    retained = F.col("effect") == "stop_retained_variant"
    early_stop = F.col("hgvs_p").rlike(hgvs.STOP_WRITTEN_AS_MISSENSE)
    effect = first_match(
        [
            (retained & early_stop, F.lit("stop_gained")),
            (retained & F.col("hgvs_p").rlike(hgvs.SINGLE_MISSENSE), F.lit("missense_variant")),
        ],
        F.col("effect"),
    )
    star = F.when(early_stop & (effect == "stop_gained"), F.regexp_replace("hgvs_p", "Ter$", "*"))
    return df.withColumns({"effect": effect, "hgvs_p": star.otherwise(F.col("hgvs_p"))})


def unpivot_hgvs(df: DataFrame) -> DataFrame:
    """One row per nucleotide or protein text, with the distance that belongs to it."""
    long = (
        df.select(
            "variant_id",
            "effect",
            "gene_id",
            "distance",
            "cds_len",
            "protein_len",
            F.col("hgvs_c").alias("nucleotidic"),
            F.col("hgvs_p").alias("proteic"),
        )
        .unpivot(
            ["variant_id", "effect", "gene_id", "distance", "cds_len", "protein_len"],
            ["nucleotidic", "proteic"],
            "type",
            "value",
        )
        .where(F.trim("value") != "")
    )
    dist = first_match(
        [
            (F.col("type") == "proteic", F.col("protein_len")),
            (F.col("effect").isin(FLANKING_EFFECTS), F.col("distance")),
        ],
        F.col("cds_len"),
    )
    return long.withColumn("dist", blank_to_null(dist)).select(*NORMALISED)


def explode_ablations(df: DataFrame) -> DataFrame:
    """One row per gene of a large deletion; effects without a gene are dropped."""
    genes = F.when(F.col("effect").isin(ABLATIONS), F.split("gene_id", "&")).otherwise(F.array("gene_id"))
    return (
        df.where(~F.col("effect").isin(DROPPED_EFFECTS))
        .withColumn("gene_id", F.explode(genes))
        .withColumn("gene_id", F.replace("gene_id", F.lit("gene-"), F.lit("")))
    )


def fix_hgvs(df: DataFrame) -> DataFrame:
    """``p.465`` means unchanged; a start loss spanning several residues names the first one only."""
    value = F.regexp_replace("value", hgvs.BARE_POSITION, "p.=")
    first = F.concat(F.lit("p."), F.regexp_extract(value, hgvs.SEVERAL_START_LOST, 1), F.lit("1?"))
    return df.withColumn("value", F.when(value.rlike(hgvs.SEVERAL_START_LOST), first).otherwise(value))


def split_multi_missense(df: DataFrame) -> DataFrame:
    """``p.AspGly95LeuSer`` to one row per changed residue, with its own position and effect."""
    lumped = F.col("value").rlike(hgvs.SEVERAL_MISSENSE)
    start = F.regexp_extract("value", "([0-9]+)", 1).cast("int")
    before, after = F.regexp_extract("value", r"^p\.(\D+)", 1), F.regexp_extract("value", r"[0-9](\D+)$", 1)
    residues = F.arrays_zip(
        F.regexp_extract_all(before, F.lit(f"({hgvs.RESIDUE})"), F.lit(1)).alias("old"),
        F.regexp_extract_all(after, F.lit(f"({hgvs.RESIDUE})"), F.lit(1)).alias("new"),
    )
    changes = F.transform(
        residues,
        lambda pair, i: F.struct(
            (start + i).cast("string").alias("dist"),
            F.concat(
                F.lit("p."), pair["old"], (start + i).cast("string"), F.replace(pair["new"], F.lit("Ter"), F.lit("*"))
            ).alias("value"),
            (pair["old"] != pair["new"]).alias("changed"),
        ),
    )
    whole = F.array(F.struct(F.col("dist"), F.col("value"), F.lit(True).alias("changed")))
    rows = (
        df.withColumn("_part", F.explode(F.when(lumped, changes).otherwise(whole)))
        .where("_part.changed")
        .withColumn("_split", lumped)
        .withColumns({"dist": F.col("_part.dist"), "value": F.col("_part.value")})
    )
    effect = first_match(
        [
            (~F.col("_split"), F.col("effect")),
            (F.col("value").rlike(hgvs.GAINED_STOP), F.lit("stop_gained")),
            (F.col("value").rlike(hgvs.LOST_STOP), F.lit("stop_lost")),
            (F.col("value").rlike(hgvs.SINGLE_MISSENSE), F.lit("missense_variant")),
        ],
        F.col("effect"),
    )
    return rows.withColumn("effect", effect).select(*NORMALISED)


def missense_distance_fix(df: DataFrame) -> DataFrame:
    """The distance of a missense change is the codon its protein text names."""
    codon = F.regexp_extract("value", hgvs.SINGLE_MISSENSE, 1)
    return df.withColumn("dist", F.when(F.col("value").rlike(hgvs.SINGLE_MISSENSE), codon).otherwise(F.col("dist")))


def stage_annotations(df: DataFrame) -> DataFrame:
    """Annotator text to the six staged columns; empty text becomes NULL."""
    rows = parse_effect_annotations(df)
    for step in (
        fix_stop_retained,
        unpivot_hgvs,
        explode_ablations,
        fix_hgvs,
        split_multi_missense,
        missense_distance_fix,
    ):
        rows = step(rows)
    return rows.select(
        "variant_id",
        blank_to_null(F.col("effect")).alias("predicted_effect"),
        blank_to_null(F.col("gene_id")).alias("locus_tag_name"),
        F.col("dist").try_cast("int").alias("distance_to_reference"),
        "type",
        blank_to_null(F.col("value")).alias("hgvs_value"),
    )
