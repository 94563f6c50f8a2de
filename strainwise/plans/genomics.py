"""Gene, annotation and variant queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainwise.operators import annotations as an, genes, variants as va
from strainwise.plans.primitives import gff_features
from strainwise.plans.registry import query
from strainwise.session import cut_lineage

_LABEL = """SELECT x.dbxref_id AS gene_db_crossref_id, q.value AS {{0}} FROM {seqfeature_dbxref} x JOIN {qualifier} q ON q.seqfeature_id = x.seqfeature_id JOIN {seqfeature} f ON f.seqfeature_id = x.seqfeature_id
JOIN {term} k ON k.term_id = q.term_id AND k.name = '{{1}}' JOIN {term} y ON y.term_id = f.type_term_id AND y.name = 'gene'"""


def _label(name, kind):
    return _LABEL.replace("{{0}}", name).replace("{{1}}", kind)


@query("gene_label", _label("gene_symbol", "gene"))
def _(t):
    return genes.gene_label(t.seqfeature_dbxref, t.qualifier, t.seqfeature, t.term, "gene")


@query("gene_label_locus_tag", _label("rv_symbol", "locus_tag"))
def _(t):
    return genes.gene_label(t.seqfeature_dbxref, t.qualifier, t.seqfeature, t.term, "locus_tag")


@query("resolved_symbol", "SELECT gene_db_crossref_id, resolved_symbol FROM {symbol}")
def _(t):
    return genes.resolved_symbol(t.gene_symbol, t.locus_tag)


@query("protein_to_gene", "SELECT d.dbxref_id AS protein_db_crossref_id, x.dbxref_id AS gene_db_crossref_id FROM {dbxref} d JOIN {qualifier} q ON q.value = d.accession JOIN {seqfeature_dbxref} x ON x.seqfeature_id = q.seqfeature_id WHERE d.dbname = 'Protein'")
def _(t):
    return genes.protein_to_gene(t.dbxref, t.qualifier, t.seqfeature_dbxref)


@query("positive_strand_stop", "SELECT DISTINCT p.gene_db_crossref_id, l.end_pos - 2 AS end_pos FROM {location} l JOIN {seqfeature_dbxref} x ON x.seqfeature_id = l.seqfeature_id JOIN {protein} p ON p.gene_db_crossref_id = x.dbxref_id WHERE l.strand = 1")
def _(t):
    return genes.positive_strand_stop(t.location, t.seqfeature_dbxref, t.protein)


@query("gene_intervals", "SELECT 'chr1' AS contig, CAST(gene_db_crossref_id * 20 AS BIGINT) AS start, CAST(gene_db_crossref_id * 20 + 20 AS BIGINT) AS \"end\", rv_symbol AS locus_tag FROM {locus_tag}")
def _(t):
    return genes.gene_intervals(gff_features(t))


@query(
    "gene_models",
    """SELECT CAST(l.gene_db_crossref_id AS STRING) AS gene_id, l.rv_symbol AS gene_locus_tag, s.resolved_symbol AS gene_name, '1' AS chrom, CAST(l.gene_db_crossref_id * 20 + 1 AS BIGINT) AS start, CAST(l.gene_db_crossref_id * 20 + 20 AS BIGINT) AS stop,
 'T' || CAST(l.gene_db_crossref_id AS STRING) || ':' || CAST(l.gene_db_crossref_id * 20 + 1 AS STRING) || '-' || CAST(l.gene_db_crossref_id * 20 + 9 AS STRING) || ',' || CAST(l.gene_db_crossref_id * 20 + 11 AS STRING) || '-' || CAST(l.gene_db_crossref_id * 20 + 20 AS STRING) AS transcripts,
 (SELECT string_agg(DISTINCT w, '|' ORDER BY w) FROM (VALUES (CAST(l.gene_db_crossref_id AS STRING)), (l.rv_symbol), (s.resolved_symbol), ('syn' || CAST(l.gene_db_crossref_id % 3 AS STRING))) x(w)) AS search_terms
FROM {locus_tag} l JOIN {symbol} s ON s.gene_db_crossref_id = l.gene_db_crossref_id""",
)
def _(t):
    exon = F.transform("x.exons", lambda e: F.concat(e["start"].cast("string"), F.lit("-"), e["stop"].cast("string")))
    return (
        genes.gene_models(gff_features(t))
        .withColumn("x", F.col("transcripts")[0])
        .select(
            "gene_id", "gene_locus_tag", "gene_name", "chrom", "start", "stop",
            F.concat("x.transcript_id", F.lit(":"), F.array_join(exon, ",")).alias("transcripts"),
            F.array_join("search_terms", "|").alias("search_terms"),
        )
    )


# ------------------------------------------------------------------ annotator text
# Two entries per variant: one of eight hand-picked kinds, and a plain upstream one.
_KINDS = """SELECT variant_id, gene, CAST(variant_id % 8 AS INT) AS k, codon, dist, alt FROM (SELECT e.variant_id, e.gene, e.codon, e.dist, v.alternative_nucleotide AS alt FROM {effect} e JOIN {variant} v ON v.variant_id = e.variant_id) x"""
_CODON = "CAST(codon AS STRING)"
_ENTRY_EFFECT = "split_part('missense_variant,stop_retained_variant,stop_retained_variant,missense_variant,feature_ablation,synonymous_variant,start_lost,intergenic_region', ',', k + 1)"
_ENTRY_GENE = "CASE WHEN k = 4 THEN 'gene-G' || CAST(gene AS STRING) || '&gene-G' || CAST(gene + 1 AS STRING) ELSE 'gene-G' || CAST(gene AS STRING) END"
_ENTRY_P = f"CASE k WHEN 0 THEN 'p.Ala' || {_CODON} || 'Gly' WHEN 1 THEN 'p.Ala' || {_CODON} || 'Ter' WHEN 2 THEN 'p.Ala' || {_CODON} || 'Gly' WHEN 3 THEN 'p.AspGlySer' || {_CODON} || 'LeuGlyTer' WHEN 4 THEN '' WHEN 5 THEN 'p.' || {_CODON} WHEN 6 THEN 'p.MetAlaGly1?' ELSE '' END"
EFFECT_TEXT = f"""SELECT variant_id, 'ANN=' || alt || '|' || {_ENTRY_EFFECT} || '|HIGH|sym|' || {_ENTRY_GENE} || '|transcript|T1|Coding|1/1|c.' || CAST(dist AS STRING) || 'A>' || alt || '|' || {_ENTRY_P} || '|5/90|' || CAST(dist AS STRING) || '/1000|' || {_CODON} || '/300||'
 || ',' || alt || '|upstream_gene_variant|MODIFIER|sym|gene-G' || CAST(gene + 1 AS STRING) || '|transcript|T2|Coding||c.-' || CAST(21 - dist AS STRING) || 'A>' || alt || '||||| ' || CAST(21 - dist AS STRING) || '|' || ';LOF=(x|y)' AS annotation
FROM ({_KINDS}) e""".replace("||||| ' ||", "|||||' ||").replace("|||||' || CAST(21 - dist AS STRING) || '|'", "|||||' || CAST(21 - dist AS STRING) || '|'")


@query(
    "parse_effect_annotations",
    f"""SELECT variant_id, alt AS allele, {_ENTRY_EFFECT} AS effect, replace({_ENTRY_GENE}, 'gene-', '') AS gene_id, {_ENTRY_P} AS hgvs_p, CAST(dist AS STRING) AS cds_len, {_CODON} AS protein_len, '' AS distance FROM ({_KINDS}) e
UNION ALL SELECT variant_id, alt, 'upstream_gene_variant', 'G' || CAST(gene + 1 AS STRING), '', '', '', CAST(21 - dist AS STRING) FROM ({_KINDS}) e""",
)
def _(t):
    columns = ["variant_id", "allele", "effect", "gene_id", "hgvs_p", "cds_len", "protein_len", "distance"]
    return an.parse_effect_annotations(t.sql(EFFECT_TEXT)).select(*columns)


_STAGED = f"""
SELECT variant_id, CASE k WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'missense_variant' ELSE {_ENTRY_EFFECT} END AS predicted_effect, 'G' || CAST(gene AS STRING) AS locus_tag_name, dist AS distance_to_reference, 'nucleotidic' AS type, 'c.' || CAST(dist AS STRING) || 'A>' || alt AS hgvs_value FROM ({_KINDS}) e WHERE k <> 7
UNION ALL SELECT variant_id, 'feature_ablation', 'G' || CAST(gene + 1 AS STRING), dist, 'nucleotidic', 'c.' || CAST(dist AS STRING) || 'A>' || alt FROM ({_KINDS}) e WHERE k = 4
UNION ALL SELECT variant_id, CASE k WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'missense_variant' ELSE {_ENTRY_EFFECT} END, 'G' || CAST(gene AS STRING), codon, 'proteic',
 CASE k WHEN 1 THEN 'p.Ala' || {_CODON} || '*' WHEN 5 THEN 'p.=' WHEN 6 THEN 'p.Met1?' ELSE 'p.Ala' || {_CODON} || 'Gly' END FROM ({_KINDS}) e WHERE k IN (0, 1, 2, 5, 6)
UNION ALL SELECT variant_id, 'missense_variant', 'G' || CAST(gene AS STRING), codon, 'proteic', 'p.Asp' || {_CODON} || 'Leu' FROM ({_KINDS}) e WHERE k = 3
UNION ALL SELECT variant_id, 'stop_gained', 'G' || CAST(gene AS STRING), codon + 2, 'proteic', 'p.Ser' || CAST(codon + 2 AS STRING) || '*' FROM ({_KINDS}) e WHERE k = 3
UNION ALL SELECT variant_id, 'upstream_gene_variant', 'G' || CAST(gene + 1 AS STRING), 21 - dist, 'nucleotidic', 'c.-' || CAST(21 - dist AS STRING) || 'A>' || alt FROM ({_KINDS}) e"""


@query("stage_annotations", _STAGED)
def _(t):
    return an.stage_annotations(t.sql(EFFECT_TEXT))


def _staged_where(condition, columns="variant_id, hgvs_value"):
    return f"SELECT {columns} FROM ({_STAGED}) s WHERE {condition}"


@query("fix_stop_retained", f"SELECT variant_id, CASE k WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'missense_variant' ELSE {_ENTRY_EFFECT} END AS effect, CASE k WHEN 1 THEN 'p.Ala' || {_CODON} || '*' ELSE {_ENTRY_P} END AS hgvs_p FROM ({_KINDS}) e UNION ALL SELECT variant_id, 'upstream_gene_variant', '' FROM ({_KINDS}) e")
def _(t):
    return an.fix_stop_retained(an.parse_effect_annotations(t.sql(EFFECT_TEXT))).select("variant_id", "effect", "hgvs_p")


@query(
    "unpivot_hgvs",
    f"""SELECT variant_id, {_ENTRY_EFFECT} AS effect, CAST(dist AS STRING) AS dist, 'nucleotidic' AS type FROM ({_KINDS}) e UNION ALL SELECT variant_id, {_ENTRY_EFFECT}, {_CODON}, 'proteic' FROM ({_KINDS}) e WHERE k NOT IN (4, 7)
UNION ALL SELECT variant_id, 'upstream_gene_variant', CAST(21 - dist AS STRING), 'nucleotidic' FROM ({_KINDS}) e""",
)
def _(t):
    return an.unpivot_hgvs(an.parse_effect_annotations(t.sql(EFFECT_TEXT))).select("variant_id", "effect", "dist", "type")


def _long(t):
    return an.unpivot_hgvs(an.fix_stop_retained(an.parse_effect_annotations(t.sql(EFFECT_TEXT))))


@query(
    "explode_ablations",
    f"""SELECT variant_id, 'G' || CAST(gene AS STRING) AS gene_id FROM ({_KINDS}) e WHERE k <> 7 UNION ALL SELECT variant_id, 'G' || CAST(gene + 1 AS STRING) FROM ({_KINDS}) e WHERE k = 4
UNION ALL SELECT variant_id, 'G' || CAST(gene AS STRING) FROM ({_KINDS}) e WHERE k NOT IN (4, 7) UNION ALL SELECT variant_id, 'G' || CAST(gene + 1 AS STRING) FROM ({_KINDS}) e""",
)
def _(t):
    return an.explode_ablations(_long(t)).select("variant_id", "gene_id")


@query("fix_hgvs", f"SELECT variant_id, CASE k WHEN 5 THEN 'p.=' WHEN 6 THEN 'p.Met1?' WHEN 1 THEN 'p.Ala' || {_CODON} || '*' ELSE {_ENTRY_P} END AS value FROM ({_KINDS}) e WHERE k NOT IN (4, 7)")
def _(t):
    return an.fix_hgvs(_long(t)).where("type = 'proteic'").select("variant_id", "value")


@query("split_multi_missense", _staged_where("type = 'proteic' AND hgvs_value NOT IN ('p.=', 'p.Met1?')", "variant_id, predicted_effect AS effect, hgvs_value AS value"))
def _(t):
    rows = an.split_multi_missense(an.fix_hgvs(_long(t))).where("type = 'proteic'")
    return rows.where("value not in ('p.=', 'p.Met1?')").select("variant_id", "effect", "value")


@query("missense_distance_fix", f"SELECT variant_id, {_CODON} AS dist FROM ({_KINDS}) e WHERE k IN (0, 2) UNION ALL SELECT variant_id, {_CODON} FROM ({_KINDS}) e WHERE k = 3")
def _(t):
    rows = an.missense_distance_fix(an.split_multi_missense(_long(t).withColumn("dist", F.lit("0"))))
    return rows.where("effect = 'missense_variant' and type = 'proteic'").select("variant_id", "dist")


# ------------------------------------------------------------------ variants

FAPG = r"""SELECT l.variant_id, a.reference_db_crossref_id AS gene_db_crossref_id, a.predicted_effect, a.hgvs_value AS nucleotidic_annotation, p.hgvs_value AS proteic_annotation,
 CAST(CASE WHEN a.predicted_effect = 'missense_variant' AND regexp_matches(a.hgvs_value, 'c\.[0-9]+_[0-9]+del[AGCT]+ins[AGCT]+') AND regexp_matches(p.hgvs_value, 'p\.[A-Z][a-z][a-z][0-9]+[A-Z][a-z][a-z]') THEN CAST(regexp_extract(p.hgvs_value, '([0-9]+)', 1) AS BIGINT) * 3 ELSE a.distance_to_reference END AS BIGINT) AS distance_to_reference
FROM {annotation_link} l JOIN {annotation} a ON a.annotation_id = l.annotation_id JOIN {dbxref} d ON d.dbxref_id = a.reference_db_crossref_id
LEFT JOIN (SELECT l2.variant_id, a2.hgvs_value, p2.gene_db_crossref_id FROM {annotation_link} l2 JOIN {annotation} a2 ON a2.annotation_id = l2.annotation_id JOIN {protein} p2 ON p2.protein_db_crossref_id = a2.reference_db_crossref_id) p ON p.variant_id = l.variant_id AND p.gene_db_crossref_id = a.reference_db_crossref_id
WHERE (p.gene_db_crossref_id IS NOT NULL AND a.predicted_effect <> 'upstream_gene_variant') OR a.predicted_effect IN ('non_coding_transcript_exon_variant', 'feature_ablation') OR (a.predicted_effect = 'upstream_gene_variant' AND p.hgvs_value IS NULL)"""


def fapg(t):
    return va.formatted_annotation_per_gene(t.annotation_link, t.annotation, t.dbxref, t.protein)


@query("formatted_annotation_per_gene", FAPG)
def _(t):
    return fapg(t)


@query("decompose_mnv", "SELECT mnv_id, snv_id FROM {mnv}")
def _(t):
    return va.decompose_mnv(t.variant)


@query(
    "derive_missing_snvs",
    """SELECT DISTINCT z.chromosome, CAST(z.position + z.i - 1 AS INT) AS position, substr(z.reference_nucleotide, z.i, 1) AS reference_nucleotide, substr(z.alternative_nucleotide, z.i, 1) AS alternative_nucleotide
FROM (SELECT *, unnest(generate_series(1, length(reference_nucleotide))) AS i FROM {variant} WHERE length(reference_nucleotide) > 1 AND length(reference_nucleotide) = length(alternative_nucleotide)) z
WHERE substr(z.reference_nucleotide, z.i, 1) <> substr(z.alternative_nucleotide, z.i, 1) AND NOT EXISTS (SELECT 1 FROM {variant} v WHERE v.chromosome = z.chromosome AND v.position = z.position + z.i - 1 AND v.reference_nucleotide = substr(z.reference_nucleotide, z.i, 1) AND v.alternative_nucleotide = substr(z.alternative_nucleotide, z.i, 1))""",
)
def _(t):
    return va.derive_missing_snvs(t.variant)


PURE = """SELECT m.mnv_id AS variant_id, f.gene_db_crossref_id, f.predicted_effect, f.nucleotidic_annotation, f.proteic_annotation, f.distance_to_reference FROM {mnv} m JOIN {fapg} f ON f.variant_id = m.snv_id
WHERE m.mnv_id IN (SELECT a.variant_id FROM {fapg} a JOIN {mnv} n ON n.mnv_id = a.variant_id LEFT JOIN {fapg} b ON b.variant_id = n.snv_id AND b.gene_db_crossref_id = a.gene_db_crossref_id
 WHERE a.predicted_effect = 'synonymous_variant' AND a.gene_db_crossref_id IN (SELECT gene_db_crossref_id FROM {tier}) GROUP BY a.variant_id HAVING bool_and(b.predicted_effect = 'synonymous_variant'))"""


@query("pure_synonymous_mnv", PURE)
def _(t):
    return va.pure_synonymous_mnv(t.fapg, t.tier, t.mnv)


CODONS = r"""SELECT f.variant_id, f.gene_db_crossref_id, CAST(count(DISTINCT f.proteic_annotation) AS BIGINT) AS count_missense, string_agg(DISTINCT f.proteic_annotation, '; ' ORDER BY f.proteic_annotation) AS mutations,
 list_sort(list(DISTINCT CAST(floor(1 + (f.distance_to_reference - 1) / 3) AS BIGINT))) AS all_codons_missense
FROM {fapg} f JOIN {variant} v ON v.variant_id = f.variant_id WHERE f.predicted_effect = 'missense_variant' AND regexp_matches(f.nucleotidic_annotation, 'c\.[0-9]+_[0-9]+del[AGCT]+ins[AGCT]+') AND regexp_matches(f.proteic_annotation, 'p\.[A-Z][a-z][a-z][0-9]+[A-Z][a-z][a-z]')
 AND length(v.reference_nucleotide) = length(v.alternative_nucleotide) AND f.gene_db_crossref_id IN (SELECT gene_db_crossref_id FROM {tier}) GROUP BY 1, 2"""


@query("missense_codons", f"SELECT variant_id, gene_db_crossref_id, count_missense, mutations, array_to_string(all_codons_missense, ',') AS codons FROM ({CODONS}) c")
def _(t):
    rows = va.missense_codons(t.fapg, t.variant, t.tier)
    return rows.select(
        "variant_id", "gene_db_crossref_id", "count_missense", "mutations",
        F.array_join(F.col("all_codons_missense").cast("array<string>"), ",").alias("codons"),
    )


def _tiered(frameshift):
    return rf"""
WITH joined AS (
 SELECT f.*, t.drug_id, t.tier, v.position AS own_position, w.position AS part_position, s.nucleotidic_annotation AS pure_text, g.predicted_effect AS part_effect, g.nucleotidic_annotation AS part_text, g.distance_to_reference AS part_distance
 FROM {{fapg}} f JOIN {{tier}} t ON t.gene_db_crossref_id = f.gene_db_crossref_id JOIN {{variant}} v ON v.variant_id = f.variant_id
 LEFT JOIN {{mnv}} m ON m.mnv_id = f.variant_id AND f.predicted_effect IN ('upstream_gene_variant', 'synonymous_variant', 'missense_variant', 'non_coding_transcript_exon_variant')
 LEFT JOIN ({CODONS}) c ON c.variant_id = f.variant_id AND c.gene_db_crossref_id = f.gene_db_crossref_id
 LEFT JOIN {{variant}} w ON w.variant_id = m.snv_id
 LEFT JOIN ({PURE}) s ON s.variant_id = f.variant_id AND s.gene_db_crossref_id = f.gene_db_crossref_id
 LEFT JOIN {{fapg}} g ON g.variant_id = m.snv_id AND g.gene_db_crossref_id = f.gene_db_crossref_id AND (
  (f.predicted_effect IN ('upstream_gene_variant', 'non_coding_transcript_exon_variant') AND f.predicted_effect = g.predicted_effect)
  OR (f.predicted_effect = 'missense_variant' AND g.predicted_effect IN ('synonymous_variant', 'stop_retained_variant', 'initiator_codon_variant') AND NOT list_contains(c.all_codons_missense, CAST(floor(1 + (g.distance_to_reference - 1) / 3) AS BIGINT))))),
named AS (
 SELECT *, CASE WHEN predicted_effect = 'feature_ablation' THEN 'deletion'
  WHEN predicted_effect LIKE '%frameshift%' AND regexp_matches(proteic_annotation, 'p\.Ter[0-9]+fs') THEN replace(proteic_annotation, 'fs', 'ext*?')
  WHEN predicted_effect LIKE '%stop_lost%' AND predicted_effect LIKE '%frameshift%' THEN {frameshift} WHEN predicted_effect LIKE '%stop_lost%' THEN proteic_annotation
  WHEN predicted_effect LIKE '%start_lost%' THEN 'p.Met1?' WHEN predicted_effect LIKE '%stop_gained%' THEN regexp_replace(proteic_annotation, 'fs$', '*') WHEN predicted_effect LIKE '%frameshift%' THEN {frameshift}
  WHEN predicted_effect IN ('initiator_codon_variant', 'initiator_codon_variant&non_canonical_start_codon', 'stop_retained_variant') THEN nucleotidic_annotation
  WHEN predicted_effect IN ('upstream_gene_variant', 'non_coding_transcript_exon_variant', 'synonymous_variant') THEN coalesce(pure_text, part_text, nucleotidic_annotation)
  WHEN predicted_effect = 'missense_variant' AND part_effect IN ('synonymous_variant', 'stop_retained_variant', 'initiator_codon_variant') THEN part_text ELSE proteic_annotation END AS variant_category FROM joined),
curated AS (
 SELECT *, CASE WHEN predicted_effect LIKE '%start_lost%' THEN 'start_lost' WHEN regexp_matches(predicted_effect, '(disruptive|conservative)_inframe_(deletion|insertion)') THEN regexp_extract(predicted_effect, '(inframe_(deletion|insertion))', 1)
  WHEN predicted_effect = 'missense_variant' AND part_effect IN ('synonymous_variant', 'stop_retained_variant', 'initiator_codon_variant') THEN part_effect
  WHEN predicted_effect LIKE '%frameshift%' AND regexp_matches(variant_category, 'p\.Ter[0-9]+ext\*\?') THEN 'stop_lost' WHEN predicted_effect LIKE '%stop_gained%' THEN 'stop_gained' WHEN predicted_effect LIKE '%frameshift%' THEN 'frameshift'
  WHEN predicted_effect LIKE '%feature_ablation%' THEN 'feature_ablation' WHEN predicted_effect LIKE '%stop_lost%' THEN 'stop_lost' WHEN predicted_effect LIKE '%initiator_codon_variant%' THEN 'initiator_codon_variant' ELSE predicted_effect END AS effect FROM named),
placed AS (
 SELECT drug_id, tier, gene_db_crossref_id, variant_id, CASE WHEN part_effect IS NOT NULL THEN part_position ELSE own_position END AS position, variant_category, effect AS predicted_effect, coalesce(part_distance, distance_to_reference) AS distance_to_reference FROM curated),
kept AS (SELECT DISTINCT p.* FROM placed p WHERE p.predicted_effect <> 'upstream_gene_variant' OR EXISTS (SELECT 1 FROM {{promoter}} r WHERE r.gene_db_crossref_id = p.gene_db_crossref_id AND p.distance_to_reference BETWEEN r.start AND r.`end`)),
first AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY variant_id, drug_id ORDER BY CASE WHEN predicted_effect = 'lof' THEN 1 WHEN predicted_effect IN ('missense_variant', 'synonymous_variant', 'stop_retained_variant', 'initiator_codon_variant') THEN 2 WHEN predicted_effect = 'non_coding_transcript_exon_variant' THEN 3 ELSE 4 END) AS rk FROM kept) x WHERE rk = 1),
ranked AS (SELECT * EXCLUDE (rk), CAST(rank() OVER (PARTITION BY variant_id, drug_id ORDER BY tier, gene_db_crossref_id) AS INT) AS gene_rank FROM first)
"""


def ranked(t, unpool=False):
    # The formatted annotations feed five joins: they are written once.
    fapg, mnv = cut_lineage(t.fapg), cut_lineage(t.mnv)
    return va.ranked_variant_categories(
        fapg,
        va.pure_synonymous_mnv(fapg, t.tier, mnv),
        t.tier,
        t.variant,
        mnv,
        t.promoter,
        va.missense_codons(fapg, t.variant, t.tier),
        unpool,
    )


_COUNTED = "SELECT DISTINCT * EXCLUDE (gene_rank) FROM ranked WHERE gene_rank = 1 OR predicted_effect = 'feature_ablation'"


@query("tiered_variant_categories", _tiered("proteic_annotation") + _COUNTED)
def _(t):
    return va.tiered_variant_categories(ranked(t))


@query("tiered_variant_categories_unpooled", _tiered("nucleotidic_annotation") + _COUNTED)
def _(t):
    return va.tiered_variant_categories(ranked(t, unpool=True))


@query(
    "overlap_report",
    _tiered("proteic_annotation")
    + "SELECT r.*, s.resolved_symbol, o.gene_db_crossref_id AS overlapping_gene, o.variant_category AS overlapping_category FROM ranked r JOIN (SELECT DISTINCT variant_id, drug_id, gene_db_crossref_id, variant_category FROM ranked WHERE gene_rank = 2) o ON o.variant_id = r.variant_id AND o.drug_id = r.drug_id JOIN {symbol} s ON s.gene_db_crossref_id = r.gene_db_crossref_id",
)
def _(t):
    return va.overlap_report(ranked(t), t.symbol)


@query("category_positions", "SELECT gene_db_crossref_id, variant_category, predicted_effect, string_agg(DISTINCT CAST(position AS STRING), ';' ORDER BY CAST(position AS STRING)) AS position FROM {variant_category} GROUP BY 1, 2, 3")
def _(t):
    return va.category_positions(t.variant_category)


@query(
    "ranked_annotation",
    """SELECT l.variant_id, a.annotation_id, s.resolved_symbol AS gene_name, a.predicted_effect, a.hgvs_value, a.distance_to_reference,
 CAST(rank() OVER (PARTITION BY l.variant_id ORDER BY CASE WHEN (a.predicted_effect NOT IN ('synonymous_variant', 'initiator_codon_variant', 'stop_retained_variant') AND p.protein_db_crossref_id IS NOT NULL) OR a.predicted_effect = 'non_coding_transcript_exon_variant' THEN 1
  WHEN a.predicted_effect IN ('synonymous_variant', 'initiator_codon_variant', 'stop_retained_variant') AND g.rv_symbol IS NOT NULL THEN 2 WHEN a.predicted_effect IN ('upstream_gene_variant', 'downstream_gene_variant') THEN a.distance_to_reference + 2 END NULLS LAST) AS INT) AS rank
FROM {annotation_link} l JOIN {annotation} a ON a.annotation_id = l.annotation_id LEFT JOIN {locus_tag} g ON g.gene_db_crossref_id = a.reference_db_crossref_id LEFT JOIN {protein} p ON p.protein_db_crossref_id = a.reference_db_crossref_id JOIN {symbol} s ON s.gene_db_crossref_id = coalesce(p.gene_db_crossref_id, g.gene_db_crossref_id)""",
)
def _(t):
    return va.ranked_annotation(t.annotation_link, t.annotation, t.locus_tag, t.protein, t.symbol)


@query(
    "variant_catalogue_map",
    """SELECT DISTINCT s.resolved_symbol || '_' || c.variant_category AS variant, s.resolved_symbol, c.variant_category, c.predicted_effect, v.variant_id, v.chromosome, v.position, v.reference_nucleotide, v.alternative_nucleotide
FROM {variant_category} c JOIN {variant} v ON v.variant_id = c.variant_id JOIN {symbol} s ON s.gene_db_crossref_id = c.gene_db_crossref_id
WHERE NOT EXISTS (SELECT 1 FROM {location} l WHERE l.strand = 1 AND l.seqfeature_id = c.gene_db_crossref_id * 10 AND ((v.position = l.end_pos - 2 AND length(v.reference_nucleotide) = 3 AND length(v.alternative_nucleotide) = 3)
 OR (v.position = l.end_pos - 1 AND length(v.reference_nucleotide) = 2 AND length(v.alternative_nucleotide) = 2) OR (v.position - l.end_pos IN (-2, -1) AND c.predicted_effect = 'frameshift')))""",
)
def _(t):
    stops = genes.positive_strand_stop(t.location, t.seqfeature_dbxref, t.protein)
    return va.variant_catalogue_map(t.variant_category, t.variant, t.symbol, stops)


@query(
    "exclude_listed_variants",
    "SELECT variant_id, drug_id FROM {variant_category} WHERE variant_id NOT IN (SELECT variant_id FROM {variant} WHERE (position = 12 AND reference_nucleotide = 'T' AND alternative_nucleotide = 'G') OR (position = 101 AND reference_nucleotide = 'ACG' AND alternative_nucleotide = 'CAT'))",
)
def _(t):
    listed = [(12, "T", "G"), (101, "ACG", "CAT")]
    return va.exclude_listed_variants(t.variant_category, t.variant, listed).select("variant_id", "drug_id")
