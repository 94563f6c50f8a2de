"""Variant nomenclature: from per-gene annotations to one category per variant, gene and drug."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strainwise import rules
from strainwise.functions import hgvs
from strainwise.functions.numeric import codon_of
from strainwise.functions.text import first_match, set_text
from strainwise.operators.relational import best_ranked, sample_by_key

ALLELE = ["chromosome", "position", "reference_nucleotide", "alternative_nucleotide"]
CATEGORY_COLUMNS = [
    "drug_id",
    "tier",
    "gene_db_crossref_id",
    "variant_id",
    "position",
    "variant_category",
    "predicted_effect",
    "distance_to_reference",
]


def formatted_annotation_per_gene(
    link: DataFrame, annotation: DataFrame, dbxref: DataFrame, protein: DataFrame
) -> DataFrame:
    """Nucleotide annotation of each variant and gene with the matching protein annotation, if any.

    A variant that reaches from upstream into the coding part keeps only the coding
    row.  For a missense block substitution the distance is taken from the protein
    text, since the annotator reports the start of the block.
    """
    annotated = link.select("variant_id", "annotation_id").join(annotation, "annotation_id")
    nucleotide = (
        annotated.join(dbxref.select("dbxref_id"), F.col("reference_db_crossref_id") == F.col("dbxref_id"), "left_semi")
        .select(
            "variant_id",
            F.col("reference_db_crossref_id").alias("gene_db_crossref_id"),
            "predicted_effect",
            F.col("hgvs_value").alias("nucleotidic_annotation"),
            "distance_to_reference",
        )
    )
    proteic = annotated.join(
        protein, F.col("reference_db_crossref_id") == F.col("protein_db_crossref_id")
    ).select(
        "variant_id",
        "gene_db_crossref_id",
        F.col("hgvs_value").alias("proteic_annotation"),
        F.lit(True).alias("_coding"),
    )
    effect = F.col("predicted_effect")
    coding = F.col("_coding").isNotNull()
    kept = (
        (coding & (effect != "upstream_gene_variant"))
        | effect.isin("non_coding_transcript_exon_variant", "feature_ablation")
        | ((effect == "upstream_gene_variant") & F.col("proteic_annotation").isNull())
    )
    block_missense = (
        (effect == "missense_variant")
        & F.col("nucleotidic_annotation").rlike(hgvs.DELETION_INSERTION)
        & F.col("proteic_annotation").rlike(hgvs.MISSENSE_ANYWHERE)
    )
    codon = F.regexp_extract("proteic_annotation", hgvs.MISSENSE_ANYWHERE, 1).try_cast("long")
    distance = F.when(block_missense, codon * 3).otherwise(F.col("distance_to_reference").cast("long"))
    return (
        nucleotide.join(proteic, ["variant_id", "gene_db_crossref_id"], "left")
        .where(kept)
        .withColumn("distance_to_reference", distance)
        .select(
            "variant_id",
            "gene_db_crossref_id",
            "predicted_effect",
            "nucleotidic_annotation",
            "proteic_annotation",
            "distance_to_reference",
        )
    )


def substituted_letters(variant: DataFrame) -> DataFrame:
    """The single-nucleotide changes a multi-nucleotide substitution is made of."""
    letters = F.arrays_zip(
        F.split("reference_nucleotide", "").alias("old"), F.split("alternative_nucleotide", "").alias("new")
    )
    return (
        variant.where(hgvs.same_length_substitution(F.col("reference_nucleotide"), F.col("alternative_nucleotide")))
        .select(F.col("variant_id").alias("mnv_id"), "chromosome", "position", F.posexplode(letters))
        .where(F.col("col.old") != F.col("col.new"))
        .select(
            "mnv_id",
            "chromosome",
            (F.col("position") + F.col("pos")).alias("position"),
            F.col("col.old").alias("reference_nucleotide"),
            F.col("col.new").alias("alternative_nucleotide"),
        )
    )


def decompose_mnv(variant: DataFrame) -> DataFrame:
    """(mnv_id, snv_id) for the parts that are variants of their own."""
    known = variant.select(*ALLELE, F.col("variant_id").alias("snv_id"))
    return substituted_letters(variant).join(known, ALLELE).select("mnv_id", "snv_id").distinct()


def derive_missing_snvs(variant: DataFrame) -> DataFrame:
    """Parts of multi-nucleotide substitutions that are not in the variant table yet."""
    return substituted_letters(variant).select(*ALLELE).distinct().join(variant.select(*ALLELE), ALLELE, "left_anti")


def pure_synonymous_mnv(fapg: DataFrame, tier: DataFrame, mnv: DataFrame) -> DataFrame:
    """Annotations of the parts of those synonymous substitutions whose parts are all synonymous."""
    parts = fapg.withColumnRenamed("variant_id", "snv_id")
    tiered = tier.select("gene_db_crossref_id").distinct()
    pure = (
        fapg.where(F.col("predicted_effect") == "synonymous_variant")
        .join(tiered, "gene_db_crossref_id", "left_semi")
        .select(F.col("variant_id").alias("mnv_id"), "gene_db_crossref_id")
        .join(mnv, "mnv_id")
        .join(
            parts.select("snv_id", "gene_db_crossref_id", F.col("predicted_effect").alias("_part_effect")),
            ["snv_id", "gene_db_crossref_id"],
            "left",
        )
        .groupBy("mnv_id")
        .agg(F.bool_and(F.col("_part_effect") == "synonymous_variant").alias("_pure"))
        .where("_pure")
        .select("mnv_id")
    )
    return (
        mnv.join(pure, "mnv_id", "left_semi")
        .join(parts, "snv_id")
        .select(
            F.col("mnv_id").alias("variant_id"),
            "gene_db_crossref_id",
            "predicted_effect",
            "nucleotidic_annotation",
            "proteic_annotation",
            "distance_to_reference",
        )
    )


def missense_codons(fapg: DataFrame, variant: DataFrame, tier: DataFrame) -> DataFrame:
    """Missense codons of block substitutions: their count, text and codon set per variant and gene."""
    blocks = variant.where(F.length("reference_nucleotide") == F.length("alternative_nucleotide")).select("variant_id")
    return (
        fapg.where(
            (F.col("predicted_effect") == "missense_variant")
            & F.col("nucleotidic_annotation").rlike(hgvs.DELETION_INSERTION)
            & F.col("proteic_annotation").rlike(hgvs.MISSENSE_ANYWHERE)
        )
        .join(tier.select("gene_db_crossref_id").distinct(), "gene_db_crossref_id", "left_semi")
        .join(blocks, "variant_id", "left_semi")
        .groupBy("variant_id", "gene_db_crossref_id")
        .agg(
            F.size(F.collect_set("proteic_annotation")).cast("long").alias("count_missense"),
            set_text(F.col("proteic_annotation"), "; ").alias("mutations"),
            F.sort_array(F.collect_set(codon_of(F.col("distance_to_reference")))).alias("all_codons_missense"),
        )
    )


# Effects a decomposed part lends to a missense substitution on another codon.
_NEIGHBOUR_EFFECTS = ["synonymous_variant", "stop_retained_variant", "initiator_codon_variant"]
_PAIRED_EFFECTS = ["upstream_gene_variant", "non_coding_transcript_exon_variant"]


def category_rules(frameshift_column: str) -> list[tuple[Column, Column]]:
    """Ordered rules for the variant category; the first that holds decides."""
    effect, protein, own = F.col("effect"), F.col("proteic_annotation"), F.col("nucleotidic_annotation")

    def has(word: str) -> Column:
        return effect.contains(word)

    return [
        (effect == "feature_ablation", F.lit("deletion")),
        (has("frameshift") & protein.rlike(r"p\.Ter[0-9]+fs"), F.replace(protein, F.lit("fs"), F.lit("ext*?"))),
        (has("stop_lost") & has("frameshift"), F.col(frameshift_column)),
        (has("stop_lost"), protein),
        (has("start_lost"), F.lit("p.Met1?")),
        (has("stop_gained"), F.regexp_replace(protein, "fs$", "*")),
        (has("frameshift"), F.col(frameshift_column)),
        (
            effect.isin(
                "initiator_codon_variant",
                "initiator_codon_variant&non_canonical_start_codon",
                "stop_retained_variant",
            ),
            own,
        ),
        (
            effect.isin("synonymous_variant", *_PAIRED_EFFECTS),
            F.coalesce(F.col("pure_annotation"), F.col("part_annotation"), own),
        ),
        ((effect == "missense_variant") & F.col("part_effect").isin(_NEIGHBOUR_EFFECTS), F.col("part_annotation")),
    ]


def effect_rules() -> list[tuple[Column, Column]]:
    """Ordered rules for the curated effect; the first that holds decides."""
    effect, category = F.col("effect"), F.col("variant_category")

    def has(word: str) -> Column:
        return effect.contains(word)

    return [
        (has("start_lost"), F.lit("start_lost")),
        (
            effect.rlike("(disruptive|conservative)_inframe_(deletion|insertion)"),
            F.regexp_extract(effect, "(inframe_(?:deletion|insertion))", 1),
        ),
        ((effect == "missense_variant") & F.col("part_effect").isin(_NEIGHBOUR_EFFECTS), F.col("part_effect")),
        (has("frameshift") & category.rlike(r"p\.Ter[0-9]+ext\*\?"), F.lit("stop_lost")),
        (has("stop_gained"), F.lit("stop_gained")),
        (has("frameshift"), F.lit("frameshift")),
        (has("feature_ablation"), F.lit("feature_ablation")),
        (has("stop_lost"), F.lit("stop_lost")),
        (has("initiator_codon_variant"), F.lit("initiator_codon_variant")),
    ]


def _with_decomposed_parts(fapg: DataFrame, mnv: DataFrame, positions: DataFrame, codons: DataFrame) -> DataFrame:
    """Annotation rows, repeated per part of a multi-nucleotide variant, with the part's annotation where usable."""
    parts = fapg.select(
        F.col("variant_id").alias("part_variant"),
        F.col("gene_db_crossref_id").alias("part_gene"),
        F.col("predicted_effect").alias("part_effect"),
        F.col("nucleotidic_annotation").alias("part_annotation"),
        F.col("distance_to_reference").alias("part_distance"),
    ).join(
        positions.select(F.col("variant_id").alias("part_variant"), F.col("position").alias("part_position")),
        "part_variant",
    )
    effect = F.col("effect")
    decomposed = (F.col("variant_id") == F.col("mnv_id")) & effect.isin(rules.DECOMPOSED_EFFECTS)
    same_effect = effect.isin(_PAIRED_EFFECTS) & (effect == F.col("part_effect"))
    # A part on one of the missense codons is already covered by the missense text.
    neighbour = (
        (effect == "missense_variant")
        & F.col("part_effect").isin(_NEIGHBOUR_EFFECTS)
        & ~F.array_contains("all_codons_missense", codon_of(F.col("part_distance")))
    )
    same_place = (F.col("snv_id") == F.col("part_variant")) & (F.col("gene_db_crossref_id") == F.col("part_gene"))
    return (
        fapg.withColumnRenamed("predicted_effect", "effect")
        .join(mnv, decomposed, "left")
        .join(
            codons.select("variant_id", "gene_db_crossref_id", "all_codons_missense"),
            ["variant_id", "gene_db_crossref_id"],
            "left",
        )
        .join(parts, same_place & (same_effect | neighbour), "left")
        .drop("mnv_id", "snv_id", "part_variant", "part_gene", "all_codons_missense")
    )


def ranked_variant_categories(
    fapg: DataFrame,
    pure_synonymous: DataFrame,
    tier: DataFrame,
    variant: DataFrame,
    mnv: DataFrame,
    promoter: DataFrame,
    codons: DataFrame,
    unpool_frameshifts: bool = False,
) -> DataFrame:
    """Categories of every variant, gene and drug with ``gene_rank``: 1 is the gene that counts, 2 the runner-up."""
    positions = variant.select("variant_id", "position").distinct()
    usable = fapg.where(F.col("predicted_effect") != "downstream_gene_variant")
    tiered = usable.join(tier.select("gene_db_crossref_id").distinct(), "gene_db_crossref_id", "left_semi")
    pure = pure_synonymous.select(
        "variant_id", "gene_db_crossref_id", F.col("nucleotidic_annotation").alias("pure_annotation")
    ).distinct()
    frameshift_column = "nucleotidic_annotation" if unpool_frameshifts else "proteic_annotation"

    # Promoter ranges of a gene are few; one row per gene keeps the join from repeating variants.
    ranges = promoter.groupBy("gene_db_crossref_id").agg(
        F.collect_list(F.struct(F.col("start").alias("first"), F.col("end").alias("last"))).alias("ranges")
    )
    in_promoter = F.exists("ranges", lambda r: F.col("distance_to_reference").between(r["first"], r["last"]))

    categories = (
        _with_decomposed_parts(tiered, mnv, positions, codons)
        .join(pure, ["variant_id", "gene_db_crossref_id"], "left")
        .join(positions, "variant_id")
        .withColumn("variant_category", first_match(category_rules(frameshift_column), F.col("proteic_annotation")))
        .withColumn("predicted_effect", first_match(effect_rules(), F.col("effect")))
        .select(
            "gene_db_crossref_id",
            "variant_id",
            F.when(F.col("part_effect").isNotNull(), F.col("part_position"))
            .otherwise(F.col("position"))
            .alias("position"),
            "variant_category",
            "predicted_effect",
            F.coalesce("part_distance", "distance_to_reference").alias("distance_to_reference"),
        )
        .join(ranges, "gene_db_crossref_id", "left")
        .where((F.col("predicted_effect") != "upstream_gene_variant") | in_promoter)
        .drop("ranges")
        .join(tier.select("gene_db_crossref_id", "drug_id", "tier"), "gene_db_crossref_id")
        .select(*CATEGORY_COLUMNS)
    )
    order = first_match(
        [
            (F.col("predicted_effect") == "lof", F.lit(1)),
            (F.col("predicted_effect").isin("missense_variant", *rules.SILENT_EFFECTS), F.lit(2)),
            (F.col("predicted_effect") == "non_coding_transcript_exon_variant", F.lit(3)),
        ],
        F.lit(4),
    )
    # One exchange on (variant, drug) serves the de-duplication and both ranks; the
    # group is bounded by the genes one variant can span.
    grouped = categories.repartition("variant_id", "drug_id").distinct()
    by_gene = Window.partitionBy("variant_id", "drug_id").orderBy("tier", "gene_db_crossref_id")
    return best_ranked(grouped, ["variant_id", "drug_id"], order).withColumn("gene_rank", F.rank().over(by_gene))


def tiered_variant_categories(ranked: DataFrame) -> DataFrame:
    """The categories that count: those of the best gene, and every gene a deletion removes."""
    return (
        ranked.where((F.col("gene_rank") == 1) | (F.col("predicted_effect") == "feature_ablation"))
        .select(*CATEGORY_COLUMNS)
        .distinct()
    )


def overlap_report(ranked: DataFrame, symbol: DataFrame) -> DataFrame:
    """All categories of the variants that reach a second gene, with that gene and the gene names."""
    second = (
        ranked.where("gene_rank = 2")
        .select(
            "variant_id",
            "drug_id",
            F.col("gene_db_crossref_id").alias("overlapping_gene"),
            F.col("variant_category").alias("overlapping_category"),
        )
        .distinct()
    )
    return ranked.join(second, ["variant_id", "drug_id"]).join(symbol, "gene_db_crossref_id")


def category_positions(categories: DataFrame) -> DataFrame:
    """Distinct positions of each (gene, category, effect) as one text."""
    return (
        categories.select("gene_db_crossref_id", "variant_category", "predicted_effect", "position")
        .distinct()
        .groupBy("gene_db_crossref_id", "variant_category", "predicted_effect")
        .agg(set_text(F.col("position"), ";").alias("position"))
    )


def ranked_annotation(
    link: DataFrame, annotation: DataFrame, locus: DataFrame, protein: DataFrame, symbol: DataFrame
) -> DataFrame:
    """Annotations of each variant ranked by relevance: protein or rRNA change, silent change, then by distance."""
    joined = (
        link.join(annotation, "annotation_id")
        .join(
            locus.select(F.col("gene_db_crossref_id").alias("_locus_gene"), "rv_symbol"),
            F.col("_locus_gene") == F.col("reference_db_crossref_id"),
            "left",
        )
        .join(
            protein.select("protein_db_crossref_id", F.col("gene_db_crossref_id").alias("_protein_gene")),
            F.col("protein_db_crossref_id") == F.col("reference_db_crossref_id"),
            "left",
        )
        .withColumn("gene_db_crossref_id", F.coalesce("_protein_gene", "_locus_gene"))
        .join(symbol, "gene_db_crossref_id")
    )
    effect = F.col("predicted_effect")
    silent = effect.isin(rules.SILENT_EFFECTS)
    order = first_match(
        [
            (
                (~silent & F.col("protein_db_crossref_id").isNotNull())
                | (effect == "non_coding_transcript_exon_variant"),
                F.lit(1),
            ),
            (silent & F.col("rv_symbol").isNotNull(), F.lit(2)),
            (effect.isin(rules.FLANKING_EFFECTS), F.col("distance_to_reference") + 2),
        ]
    )
    by_variant = Window.partitionBy("variant_id").orderBy(order.asc_nulls_last())
    return joined.select(
        "variant_id",
        "annotation_id",
        F.col("resolved_symbol").alias("gene_name"),
        "predicted_effect",
        "hgvs_value",
        "distance_to_reference",
        F.rank().over(by_variant).alias("rank"),
    )


def variant_catalogue_map(
    categories: DataFrame, variant: DataFrame, symbol: DataFrame, stops: DataFrame, sample_fraction: float | None = None
) -> DataFrame:
    """Catalogue name <-> coordinates, without the false missense calls at forward-strand stop codons."""
    offset = F.col("position") - F.col("stop_pos")
    length = F.length("reference_nucleotide")
    block = length == F.length("alternative_nucleotide")
    at_stop = (
        (block & (length == 3) & (offset == 0))
        | (block & (length == 2) & (offset == 1))
        | ((F.col("predicted_effect") == "frameshift") & offset.isin(0, 1))
    )
    rows = (
        categories.drop("position")
        .join(variant.select("variant_id", *ALLELE), "variant_id")
        .join(symbol, "gene_db_crossref_id")
    )
    ends = stops.select(F.col("gene_db_crossref_id").alias("_gene"), F.col("end_pos").alias("stop_pos"))
    mapped = (
        rows.join(ends, (F.col("gene_db_crossref_id") == F.col("_gene")) & at_stop, "left_anti")
        .select(
            F.concat_ws("_", "resolved_symbol", "variant_category").alias("variant"),
            "resolved_symbol",
            "variant_category",
            "predicted_effect",
            "variant_id",
            *ALLELE,
        )
        .distinct()
    )
    return mapped if sample_fraction is None else sample_by_key(mapped, ["variant", "variant_id"], sample_fraction)


def exclude_listed_variants(
    categories: DataFrame, variant: DataFrame, listed: list[tuple] = rules.LISTED_VARIANTS
) -> DataFrame:
    """Drop the variants of a short coordinate list."""
    table = rules.rule_frame(
        variant.sparkSession, listed, "position long, reference_nucleotide string, alternative_nucleotide string"
    )
    hits = variant.join(table, ["position", "reference_nucleotide", "alternative_nucleotide"]).select("variant_id")
    return categories.join(hits, "variant_id", "left_anti")
