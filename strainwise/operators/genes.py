"""Gene reference views built from a feature / qualifier / term / cross-reference store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise.session import cut_lineage

def gene_label(
    xref_link: DataFrame, qualifier: DataFrame, feature: DataFrame, term: DataFrame, kind: str, name: str | None = None
) -> DataFrame:
    """Gene id -> qualifier text of ``kind`` (``gene`` or ``locus_tag``), for features of type ``gene``."""
    kinds = term.where(F.col("name") == kind).select("term_id")
    gene_type = term.where(F.col("name") == "gene").select(F.col("term_id").alias("type_term_id"))
    genes = feature.join(gene_type, "type_term_id", "left_semi").select("seqfeature_id")
    label = name or {"gene": "gene_symbol", "locus_tag": "rv_symbol"}[kind]
    return (
        qualifier.join(kinds, "term_id", "left_semi")
        .join(genes, "seqfeature_id")
        .join(xref_link, "seqfeature_id")
        .select(F.col("dbxref_id").alias("gene_db_crossref_id"), F.col("value").alias(label))
    )


def resolved_symbol(gene: DataFrame, locus: DataFrame) -> DataFrame:
    """Gene symbol where there is one, else the locus tag."""
    return locus.join(gene, "gene_db_crossref_id", "left").select(
        "gene_db_crossref_id", F.coalesce("gene_symbol", "rv_symbol").alias("resolved_symbol")
    )


def protein_to_gene(dbxref: DataFrame, qualifier: DataFrame, xref_link: DataFrame) -> DataFrame:
    """Protein cross-reference -> gene cross-reference, matched on the accession text."""
    protein = dbxref.where(F.col("dbname") == "Protein").select(
        F.col("dbxref_id").alias("protein_db_crossref_id"), F.col("accession").alias("value")
    )
    carrier = xref_link.select("seqfeature_id", F.col("dbxref_id").alias("gene_db_crossref_id"))
    return (
        qualifier.select("seqfeature_id", "value")
        .join(protein, "value")
        .join(carrier, "seqfeature_id")
        .select("protein_db_crossref_id", "gene_db_crossref_id")
    )


def positive_strand_stop(location: DataFrame, xref_link: DataFrame, protein: DataFrame) -> DataFrame:
    """First base of the stop codon of every protein gene on the forward strand."""
    coding = protein.select("gene_db_crossref_id").distinct()
    return (
        location.where(F.col("strand") == 1)
        .join(xref_link.select("seqfeature_id", F.col("dbxref_id").alias("gene_db_crossref_id")), "seqfeature_id")
        .join(coding, "gene_db_crossref_id", "left_semi")
        .select("gene_db_crossref_id", (F.col("end_pos") - 2).alias("end_pos"))
        .distinct()
    )


def gene_intervals(features: DataFrame) -> DataFrame:
    """Gene features as zero-based, half-open rows (contig, start, end, locus tag)."""
    return features.where(F.col("feature") == "gene").select(
        "contig",
        (F.col("start") - 1).alias("start"),
        "end",
        F.try_element_at("attributes", F.lit("locus_tag")).alias("locus_tag"),
    )


def _plain_contig(column: str = "contig"):
    return F.regexp_replace(column, "^chr", "").alias("chrom")


def gene_models(features: DataFrame) -> DataFrame:
    """One row per gene with its transcripts, their exons, and the terms it can be searched by."""

    def attribute(name: str):
        return F.try_element_at("attributes", F.lit(name))

    def unversioned(name: str):
        return F.substring_index(attribute(name), ".", 1)

    # Three kinds of features are taken from the lines; written once, each line is parsed once.
    features = cut_lineage(features)
    spot = ["strand", "start", F.col("end").alias("stop")]
    exons = features.where(F.col("feature") == "exon").select(
        unversioned("transcript_id").alias("transcript_id"),
        F.struct(F.col("start"), F.col("end").alias("stop"), F.col("feature").alias("feature_type")).alias("exon"),
    )
    exon_lists = exons.groupBy("transcript_id").agg(F.sort_array(F.collect_list("exon")).alias("exons"))
    transcripts = (
        features.where(F.col("feature") == "transcript")
        .select(
            unversioned("transcript_id").alias("transcript_id"),
            attribute("Dbxref_GeneID").alias("gene_id"),
            *spot,
        )
        .join(exon_lists, "transcript_id", "left")
        .groupBy("gene_id")
        .agg(F.sort_array(F.collect_list(F.struct("transcript_id", "strand", "start", "stop", "exons"))).alias("transcripts"))
    )
    genes = (
        features.where(F.col("feature") == "gene")
        .select(
            attribute("Dbxref_GeneID").alias("gene_id"),
            attribute("locus_tag").alias("gene_locus_tag"),
            attribute("gene").alias("gene_name"),
            F.array(attribute("gene_synonym")).alias("gene_synonym"),
            _plain_contig(),
            *spot,
        )
        .dropDuplicates(["gene_id"])
    )
    terms = F.array_union(F.array("gene_id", "gene_locus_tag", "gene_name"), F.col("gene_synonym"))
    return genes.join(transcripts, "gene_id", "left").withColumn(
        "search_terms", F.sort_array(F.array_distinct(F.array_compact(terms)))
    )
