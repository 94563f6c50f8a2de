"""Domain tables derived from the test tables, in SQL that Spark and DuckDB both run.

``{name}`` in a view stands for another view or a parquet table.  Everything is whole
tables and exact integer arithmetic, so both engines see the same rows.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_GENE = "CAST(floor(p_partkey / 20) AS INT)"
_BLOCK = "CAST(floor(p_partkey / 5) AS INT)"
_DIST = "CAST(p_partkey % 20 + 1 AS INT)"
_CODON = f"CAST(floor(1 + (p_partkey % 20) / 3) AS INT)"
_SYMBOLS = (
    "katG,rpoB,pncA,embB,gyrA,gyrB,rrs,eis,tlyA,gid,ethA,inhA,fabG1,mmpL5,pepQ,ddn,fbiA,rrl,rpsL,rplC,embA,Rv0678,"
    "fgd1,PE_PGRS23,PPE24"
)
_DRUGS = (
    "Isoniazid,Rifampicin,Pyrazinamide,Ethambutol,Levofloxacin,Moxifloxacin,Amikacin,Kanamycin,Capreomycin,"
    "Streptomycin,Ethionamide,Prothionamide,Ofloxacin,Bedaquiline,Clofazimine,Delamanid,Pretomanid,Linezolid,"
    "Cycloserine,Rifabutin,Para-Aminosalicylic Acid,Terizidone,Rifapentine,Gatifloxacin,Thioacetazone"
)
_MEDIA = "Middlebrook7H10,LJ,Middlebrook7H11,Agar,MGIT,MODS,BACTEC460,Sauton"

VIEWS: dict[str, str] = {}

# ------------------------------------------------------------------ reference tables
VIEWS["drug"] = f"SELECT CAST(n_nationkey + 1 AS INT) AS drug_id, split_part('{_DRUGS}', ',', n_nationkey + 1) AS drug_name FROM {{nation}}"
VIEWS["drug_synonym"] = (
    "SELECT drug_id, 'three_letter_code' AS code, upper(substr(drug_name, 1, 3)) || CAST(drug_id AS STRING) AS drug_name_synonym FROM {drug}"
)
VIEWS["medium"] = f"SELECT CAST(n_nationkey + 1 AS INT) AS medium_id, CASE WHEN n_nationkey < 8 THEN split_part('{_MEDIA}', ',', n_nationkey + 1) ELSE 'Medium ' || n_name END AS medium_name FROM {{nation}}"
VIEWS["method"] = (
    "SELECT CAST(r_regionkey + 1 AS INT) AS method_id, CASE r_regionkey WHEN 0 THEN 'Proportions' WHEN 1 THEN 'Ratios' ELSE 'Method ' || r_name END AS method_name FROM {region}"
)
VIEWS["country"] = (
    "SELECT CAST(n_nationkey + 1 AS INT) AS country_id, 'C' || lpad(CAST(n_nationkey AS STRING), 2, '0') AS three_letters_code, n_name AS country_usual_name FROM {nation}"
)
VIEWS["package"] = "SELECT s_suppkey AS id, s_name AS name FROM {supplier}"

# ------------------------------------------------------------------ genes and variants
VIEWS["gene_ids"] = f"SELECT DISTINCT {_GENE} AS gene FROM {{part}}"
VIEWS["gene_symbol"] = (
    f"SELECT gene AS gene_db_crossref_id, split_part('{_SYMBOLS}', ',', gene % 25 + 1) AS gene_symbol FROM {{gene_ids}} WHERE gene % 3 <> 2"
)
VIEWS["locus_tag"] = "SELECT gene AS gene_db_crossref_id, 'Rv' || lpad(CAST(gene AS STRING), 4, '0') AS rv_symbol FROM {gene_ids}"
VIEWS["symbol"] = (
    "SELECT l.gene_db_crossref_id, coalesce(g.gene_symbol, l.rv_symbol) AS resolved_symbol FROM {locus_tag} l LEFT JOIN {gene_symbol} g ON g.gene_db_crossref_id = l.gene_db_crossref_id"
)
VIEWS["gene_name"] = f"SELECT gene AS gene_db_crossref_id, split_part('{_SYMBOLS}', ',', gene % 25 + 1) AS gene_name FROM {{gene_ids}}"
VIEWS["tier"] = (
    "SELECT gene AS gene_db_crossref_id, gene % 25 + 1 AS drug_id, gene % 2 + 1 AS tier FROM {gene_ids} "
    "UNION ALL SELECT gene, (gene + 1) % 25 + 1, (gene + 1) % 2 + 1 FROM {gene_ids}"
)
VIEWS["promoter"] = (
    "SELECT gene AS gene_db_crossref_id, 1 AS start, 5 + gene % 7 AS \"end\" FROM {gene_ids} "
    "UNION ALL SELECT gene, 11, 15 + gene % 5 FROM {gene_ids}"
).replace('"end"', "`end`")
_L = "substr('{0}', CAST((p_partkey + {1}) % 4 + 1 AS INT), 1)"
VIEWS["variant"] = (
    "SELECT CAST(p_partkey AS INT) AS variant_id, 'chr1' AS chromosome, CAST(p_partkey + 1 AS INT) AS position, "
    f"CASE WHEN p_partkey % 5 = 0 THEN {_L.format('ACGT', 0)} || {_L.format('ACGT', 1)} || {_L.format('ACGT', 2)} ELSE {_L.format('ACGT', 0)} END AS reference_nucleotide, "
    f"CASE WHEN p_partkey % 5 = 0 THEN {_L.format('CATG', 0)} || {_L.format('CATG', 1)} || {_L.format('CATG', 2)} ELSE {_L.format('CATG', 0)} END AS alternative_nucleotide "
    "FROM {part}"
)
# Effects: substitutions (p % 5 = 0) and their parts (1, 2) share a block so that every
# decomposition case occurs; 3 and 4 run through the other effects.
VIEWS["effect"] = f"""
SELECT CAST(p_partkey AS INT) AS variant_id, {_GENE} AS gene, {_DIST} AS dist, {_CODON} AS codon,
 CASE
  WHEN p_partkey % 5 = 0 THEN CASE {_BLOCK} % 4 WHEN 0 THEN 'synonymous_variant' WHEN 2 THEN 'upstream_gene_variant' ELSE 'missense_variant' END
  WHEN p_partkey % 5 = 1 THEN CASE {_BLOCK} % 4 WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'upstream_gene_variant' ELSE 'synonymous_variant' END
  WHEN p_partkey % 5 = 2 THEN CASE {_BLOCK} % 4 WHEN 0 THEN 'synonymous_variant' WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'upstream_gene_variant' ELSE CASE WHEN {_BLOCK} % 8 = 3 THEN 'stop_retained_variant' ELSE 'missense_variant' END END
  ELSE split_part('frameshift_variant,stop_gained,conservative_inframe_deletion,frameshift_variant&stop_lost,start_lost,non_coding_transcript_exon_variant,feature_ablation,initiator_codon_variant,stop_lost,disruptive_inframe_insertion,frameshift_variant&stop_gained,downstream_gene_variant', ',', CAST(({_BLOCK} + 5 * (p_partkey % 5)) % 12 + 1 AS INT))
 END AS effect
FROM {{part}}"""
VIEWS["effect_text"] = """
SELECT e.variant_id, e.gene, e.dist, e.codon, e.effect,
 CASE WHEN e.effect IN ('upstream_gene_variant', 'downstream_gene_variant') THEN 'c.-' || CAST(e.dist AS STRING) || v.reference_nucleotide || '>' || v.alternative_nucleotide
  WHEN e.effect = 'non_coding_transcript_exon_variant' THEN 'n.' || CAST(e.dist AS STRING) || v.reference_nucleotide || '>' || v.alternative_nucleotide
  WHEN length(v.reference_nucleotide) > 1 THEN 'c.' || CAST(e.dist AS STRING) || '_' || CAST(e.dist + 2 AS STRING) || 'del' || v.reference_nucleotide || 'ins' || v.alternative_nucleotide
  ELSE 'c.' || CAST(e.dist AS STRING) || v.reference_nucleotide || '>' || v.alternative_nucleotide END AS nucleotidic,
 CASE WHEN e.effect IN ('upstream_gene_variant', 'downstream_gene_variant', 'non_coding_transcript_exon_variant', 'feature_ablation') THEN NULL
  WHEN e.effect = 'frameshift_variant&stop_lost' THEN 'p.Ter' || CAST(e.codon AS STRING) || 'fs'
  WHEN e.effect LIKE 'frameshift%' THEN 'p.Ala' || CAST(e.codon AS STRING) || 'fs'
  WHEN e.effect = 'stop_gained' THEN 'p.Ala' || CAST(e.codon AS STRING) || '*'
  WHEN e.effect = 'start_lost' THEN 'p.Val1?'
  WHEN e.effect = 'stop_lost' THEN 'p.Ter' || CAST(e.codon AS STRING) || 'Ala'
  WHEN e.effect LIKE '%inframe%' THEN 'p.Ala' || CAST(e.codon AS STRING) || 'dup'
  WHEN e.effect IN ('synonymous_variant', 'stop_retained_variant', 'initiator_codon_variant') THEN 'p.Ala' || CAST(e.codon AS STRING) || 'Ala'
  ELSE 'p.Ala' || CAST(e.codon AS STRING) || 'Gly' END AS proteic
FROM {effect} e JOIN {variant} v ON v.variant_id = e.variant_id"""
VIEWS["annotation"] = """
SELECT variant_id * 10 + 1 AS annotation_id, gene AS reference_db_crossref_id, effect AS predicted_effect, nucleotidic AS hgvs_value, dist AS distance_to_reference FROM {effect_text}
UNION ALL SELECT variant_id * 10 + 2, 100000 + gene, effect, proteic, codon FROM {effect_text} WHERE proteic IS NOT NULL
UNION ALL SELECT variant_id * 10 + 3, gene + 1, effect, nucleotidic, 21 - dist FROM {effect_text} WHERE effect = 'upstream_gene_variant'
UNION ALL SELECT variant_id * 10 + 4, gene, 'upstream_gene_variant', 'c.-1del', 1 FROM {effect_text} WHERE effect = 'start_lost'"""
VIEWS["annotation_link"] = "SELECT CAST(floor(annotation_id / 10) AS INT) AS variant_id, annotation_id FROM {annotation}"
VIEWS["dbxref"] = (
    "SELECT gene AS dbxref_id, 'Gene' AS dbname, 'G' || CAST(gene AS STRING) AS accession FROM {gene_ids} "
    "UNION ALL SELECT 100000 + gene, 'Protein', 'NP_' || CAST(gene AS STRING) FROM {gene_ids}"
)
VIEWS["term"] = "SELECT CAST(r_regionkey + 1 AS INT) AS term_id, split_part('gene,CDS,locus_tag,protein_id,product', ',', r_regionkey + 1) AS name FROM {region}"
# Term ids come from a column: joined on a constant, a table would be paired with all rows.
VIEWS["seqfeature"] = "SELECT gene * 10 AS seqfeature_id, CAST(gene - gene + 1 AS INT) AS type_term_id FROM {gene_ids} UNION ALL SELECT gene * 10 + 1, CAST(gene - gene + 2 AS INT) FROM {gene_ids}"
VIEWS["seqfeature_dbxref"] = "SELECT gene * 10 AS seqfeature_id, gene AS dbxref_id FROM {gene_ids} UNION ALL SELECT gene * 10 + 1, gene FROM {gene_ids}"
VIEWS["qualifier"] = """
SELECT gene_db_crossref_id * 10 AS seqfeature_id, CAST(gene_db_crossref_id - gene_db_crossref_id + 1 AS INT) AS term_id, gene_symbol AS value FROM {gene_symbol}
UNION ALL SELECT gene_db_crossref_id * 10 + 1, CAST(gene_db_crossref_id - gene_db_crossref_id + 1 AS INT), gene_symbol FROM {gene_symbol}
UNION ALL SELECT gene_db_crossref_id * 10, CAST(gene_db_crossref_id - gene_db_crossref_id + 3 AS INT), rv_symbol FROM {locus_tag}
UNION ALL SELECT gene * 10 + 1, CAST(gene - gene + 4 AS INT), 'NP_' || CAST(gene AS STRING) FROM {gene_ids}
UNION ALL SELECT gene * 10 + 1, CAST(gene - gene + 5 AS INT), CASE WHEN gene % 25 = 22 THEN 'putative transposase' ELSE 'protein ' || CAST(gene AS STRING) END FROM {gene_ids}"""
VIEWS["location"] = (
    "SELECT gene * 10 AS seqfeature_id, CASE WHEN gene % 2 = 0 THEN 1 ELSE -1 END AS strand, gene * 20 + 1 AS start_pos, gene * 20 + 20 AS end_pos FROM {gene_ids} "
    "UNION ALL SELECT gene * 10 + 1, CASE WHEN gene % 2 = 0 THEN 1 ELSE -1 END, gene * 20 + 1, gene * 20 + 20 FROM {gene_ids}"
)
VIEWS["protein"] = "SELECT 100000 + gene AS protein_db_crossref_id, gene AS gene_db_crossref_id FROM {gene_ids}"
# Formatted annotations, mnv parts and categories as tables, for the operators downstream of them.
VIEWS["fapg"] = """
SELECT variant_id, gene AS gene_db_crossref_id, effect AS predicted_effect, nucleotidic AS nucleotidic_annotation, proteic AS proteic_annotation,
 CAST(CASE WHEN effect = 'missense_variant' AND nucleotidic LIKE '%del%ins%' THEN codon * 3 ELSE dist END AS BIGINT) AS distance_to_reference
FROM {effect_text} WHERE effect <> 'downstream_gene_variant'
UNION ALL SELECT variant_id, gene + 1, effect, nucleotidic, proteic, CAST(21 - dist AS BIGINT) FROM {effect_text} e WHERE effect = 'upstream_gene_variant' AND EXISTS (SELECT 1 FROM {gene_ids} g WHERE g.gene = e.gene + 1)"""
VIEWS["mnv"] = """
SELECT DISTINCT m.variant_id AS mnv_id, s.variant_id AS snv_id FROM (
  SELECT variant_id, chromosome, position + o.step AS position, substr(reference_nucleotide, o.step + 1, 1) AS reference_nucleotide,
   substr(alternative_nucleotide, o.step + 1, 1) AS alternative_nucleotide
  FROM (SELECT *, CASE WHEN length(reference_nucleotide) = 3 AND length(alternative_nucleotide) = 3 THEN 3 ELSE 0 END AS width FROM {variant}) v
  JOIN (SELECT 3 AS wide, 0 AS step UNION ALL SELECT 3, 1 UNION ALL SELECT 3, 2) o ON o.wide = v.width
) m JOIN {variant} s
 ON s.chromosome = m.chromosome AND s.position = m.position
 AND s.reference_nucleotide = m.reference_nucleotide AND s.alternative_nucleotide = m.alternative_nucleotide
 AND s.reference_nucleotide <> s.alternative_nucleotide"""
VIEWS["variant_category"] = """
SELECT e.variant_id, e.gene AS gene_db_crossref_id, t.drug_id, t.tier, e.variant_id + 1 AS position,
 CASE WHEN e.variant_id % 20 IN (1, 2) THEN 'p.Ser315Thr' WHEN e.variant_id % 20 = 3 THEN 'p.Val170Phe' WHEN e.variant_id % 20 = 4 THEN 'c.-11A>G'
  WHEN e.variant_id % 20 = 5 THEN 'p.Met306Ile' WHEN e.variant_id % 20 = 6 THEN 'p.Gly88Ala' WHEN e.variant_id % 20 = 7 THEN 'n.1401A>G'
  WHEN e.variant_id % 20 = 8 THEN 'c.-14C>T' WHEN e.variant_id % 20 IN (9, 10, 11) THEN 'p.Ala9Gly' ELSE e.nucleotidic END AS variant_category,
 CASE WHEN e.effect LIKE 'frameshift%' THEN 'frameshift' WHEN e.effect LIKE '%inframe%' THEN substr(e.effect, strpos_inframe) ELSE e.effect END AS predicted_effect,
 CAST(CASE WHEN e.gene % 25 = 1 THEN 1270 + 3 * e.dist ELSE e.dist END AS BIGINT) AS distance_to_reference
FROM {effect_text} e JOIN {tier} t ON t.gene_db_crossref_id = e.gene""".replace(
    "substr(e.effect, strpos_inframe)", "CASE WHEN e.effect LIKE '%deletion' THEN 'inframe_deletion' ELSE 'inframe_insertion' END"
)

# ------------------------------------------------------------------ samples and calls
VIEWS["calls"] = """
SELECT CAST(o_custkey AS INT) AS sample_id, CAST(l_partkey AS INT) AS variant_id,
 CASE l_linenumber % 3 WHEN 0 THEN 'bcftools' WHEN 1 THEN 'freebayes' ELSE 'delly' END AS genotyper, l_extendedprice AS quality,
 CAST(l_quantity AS INT) AS total_dp, CAST(floor(l_quantity * (100 - floor(900 * l_discount + 0.5)) / 100) AS INT) AS alternative_ad
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
VIEWS["genotype"] = "SELECT *, total_dp - alternative_ad AS reference_ad FROM {calls}"
# Allele fraction in whole hundredths, rounded half to even: the oracles compare with this.
VIEWS["genotype_af"] = """
SELECT sample_id, variant_id, genotyper, quality, total_dp, alternative_ad, q, r,
 CAST(q + CASE WHEN 2 * r > total_dp OR (2 * r = total_dp AND q % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 100 AS af
FROM (SELECT *, CAST(floor(100 * alternative_ad / total_dp) AS INT) AS q, 100 * alternative_ad - total_dp * CAST(floor(100 * alternative_ad / total_dp) AS INT) AS r FROM {genotype}) g"""
VIEWS["sample"] = """
SELECT CAST(c_custkey AS INT) AS sample_id, CAST(c_custkey AS INT) AS id, 'S' || CAST(c_custkey AS STRING) AS sample_name, 'SRS' || CAST(c_custkey AS STRING) AS sra_name,
 CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'C' || lpad(CAST(c_nationkey AS STRING), 2, '0') END AS country_id,
 CASE c_custkey % 5 WHEN 0 THEN 'Uploaded to S3' WHEN 1 THEN 'Uploaded to S3' WHEN 2 THEN 'Annotated' WHEN 3 THEN 'Unprocessed' ELSE NULL END AS bioanalysis_status,
 CASE WHEN c_custkey % 2 = 0 THEN 'NCBI' ELSE 'local' END AS origin
FROM {customer}"""
VIEWS["sample_alias"] = """
SELECT CAST(o_orderkey AS INT) AS id, CAST(o_custkey AS INT) AS sample_id, CASE WHEN o_orderkey % 50 = 7 THEN 'TB03805142' ELSE 'A' || CAST(o_orderkey % 1000 AS STRING) END AS name,
 'fq' || CAST(o_orderkey % 5 AS STRING) AS fastq_prefix, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'C' || lpad(CAST(o_orderkey % 25 AS STRING), 2, '0') END AS country_id,
 CASE WHEN o_orderkey % 2 = 0 THEN 'BioSample' ELSE 'Lab' END AS origin, CASE WHEN o_orderkey % 3 = 1 THEN 'Sample name' ELSE 'Other' END AS origin_label, o_orderkey % 130 AS package_id
FROM {orders}"""
VIEWS["sequencing"] = """
SELECT CAST(o_orderkey AS INT) AS id, CAST(o_custkey AS INT) AS sample_id, 'ERR' || CAST(o_orderkey AS STRING) AS library_name,
 CASE WHEN o_orderkey % 9 = 0 THEN 'NANOPORE' ELSE 'ILLUMINA' END AS sequencing_platform, CASE WHEN o_orderkey % 7 = 0 THEN 'AMPLICON' ELSE 'WGS' END AS library_preparation_strategy,
 CASE WHEN o_orderkey % 8 = 0 THEN 'SINGLE' ELSE 'PAIRED' END AS library_layout, CASE WHEN o_orderkey % 6 = 0 THEN 'CNCB' ELSE 'S3' END AS data_location,
 CASE WHEN o_orderkey % 3 = 0 THEN 'Deeplex' ELSE NULL END AS assay, 'p/' || CAST(o_orderkey AS STRING) || '.fq' AS file_path
FROM {orders}"""
VIEWS["sequencing_hash"] = "SELECT CAST(o_orderkey AS INT) AS sequencing_data_id, md5(CAST(o_orderkey AS STRING)) AS value FROM {orders}"
VIEWS["summary_stats"] = (
    "SELECT CAST(c_custkey AS INT) AS sample_id, CAST(c_custkey % 60 AS DOUBLE) AS median_depth, CAST(90 + c_custkey % 11 AS DOUBLE) / 100 AS coverage_20x FROM {customer}"
)
VIEWS["locus_stats"] = """
SELECT CAST(o_custkey AS INT) AS sample_id, CAST(floor(l_partkey / 20) AS INT) AS gene_db_crossref_id,
 CAST(min(CASE WHEN l_partkey % 3 = 0 THEN 90 ELSE 100 END) AS DOUBLE) / 100 AS coverage_10x, CAST(max(l_partkey % 30) AS DOUBLE) AS mean_depth
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey GROUP BY o_custkey, CAST(floor(l_partkey / 20) AS INT)"""
VIEWS["cohort"] = """
SELECT DISTINCT s.sample_id FROM {summary_stats} s JOIN {sequencing} q ON q.sample_id = s.sample_id
WHERE q.sequencing_platform = 'ILLUMINA' AND q.library_preparation_strategy = 'WGS' AND s.median_depth > 15 AND s.coverage_20x > 0.95"""
VIEWS["clean_phenotype"] = """
SELECT CAST(o_custkey AS INT) AS sample_id, CAST(o_orderkey % 25 + 1 AS INT) AS drug_id, CASE WHEN max(o_orderkey) % 6 = 0 THEN 'R' ELSE 'S' END AS phenotype,
 split_part('WHO_current,non_WHO_CC_SR,WHO_past,WHO_undefined,non_WHO_CC_R,non_WHO_CC_S,CRyPTIC_MIC,MYCOTB_MIC,CC_WHO_MIC,CC-ATU_CRyPTIC_MIC', ',', CAST(min(o_orderkey) % 10 + 1 AS INT)) AS phenotypic_category
FROM {orders} GROUP BY o_custkey, o_orderkey % 25"""
VIEWS["neutral_calls"] = """
SELECT g.sample_id, g.variant_id, g.af AS percent_reads, c.gene_db_crossref_id, c.drug_id, c.tier, c.position, c.variant_category, c.predicted_effect, c.distance_to_reference, p.phenotype
FROM {genotype_af} g JOIN {cohort} h ON h.sample_id = g.sample_id JOIN {variant_category} c ON c.variant_id = g.variant_id
JOIN {clean_phenotype} p ON p.sample_id = g.sample_id AND p.drug_id = c.drug_id
WHERE g.genotyper IN ('freebayes', 'delly') AND g.quality > 1000 AND g.af > 0.75"""
VIEWS["variant_info"] = (
    "SELECT v.position, v.reference_nucleotide, v.alternative_nucleotide, 'note ' || CAST(v.variant_id % 9 AS STRING) AS v1_annotation, v.variant_id FROM {variant} v"
)
VIEWS["variant_grade"] = """
SELECT v.variant_id, v.position, v.reference_nucleotide, v.alternative_nucleotide, t.drug_id, v.variant_id % 5 + 1 AS grade, CASE WHEN v.variant_id % 7 = 0 THEN 1 ELSE 2 END AS grade_version
FROM {variant} v JOIN {effect} e ON e.variant_id = v.variant_id JOIN {tier} t ON t.gene_db_crossref_id = e.gene"""
VIEWS["named_category"] = """
SELECT DISTINCT c.variant_id, c.gene_db_crossref_id, c.drug_id, c.tier, c.variant_category, c.predicted_effect, c.distance_to_reference, n.gene_name AS resolved_symbol, n.gene_name || '_' || c.variant_category AS variant_catalogue_name
FROM {variant_category} c JOIN {gene_name} n ON n.gene_db_crossref_id = c.gene_db_crossref_id"""
VIEWS["gene_label"] = "SELECT gene_db_crossref_id, gene_name AS resolved_symbol FROM {gene_name}"
VIEWS["preferred_annotation"] = """
SELECT DISTINCT c.variant_id, n.gene_name, e.effect AS predicted_effect, c.variant_category AS hgvs_value, e.codon + CASE WHEN n.gene_name = 'rpoB' THEN 424 ELSE 0 END AS mii
FROM {variant_category} c JOIN {gene_name} n ON n.gene_db_crossref_id = c.gene_db_crossref_id JOIN {effect} e ON e.variant_id = c.variant_id"""
VIEWS["lineage_marker"] = """
SELECT v.variant_id, v.position, v.alternative_nucleotide, p.p_size % 2 = 0 AS count_presence, CAST(p.p_size AS INT) AS lineage_id
FROM {variant} v JOIN {part} p ON p.p_partkey = v.variant_id WHERE p.p_brand = 'Brand#1' OR p.p_brand = 'Brand#11'"""
VIEWS["lineage_marker_all"] = """
SELECT v.variant_id, v.position, v.alternative_nucleotide, p.p_size % 2 = 0 AS count_presence, CAST(p.p_size AS INT) AS lineage_id
FROM {variant} v JOIN {part} p ON p.p_partkey = v.variant_id"""
VIEWS["lineage"] = "SELECT DISTINCT CAST(p_size AS INT) AS id, '4.' || CAST(p_size AS STRING) AS lineage_numbering FROM {part}"

# ------------------------------------------------------------------ laboratory tests
VIEWS["pdstest"] = """
SELECT CAST(o_orderkey AS INT) AS test_id, CAST(o_custkey AS INT) AS sample_id, CAST(o_orderkey % 25 + 1 AS INT) AS drug_id,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 8 + 1 AS INT) END AS medium_id,
 CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 2 + 1 AS INT) END AS method_id,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 4 AS DOUBLE) / 2 END AS concentration,
 CASE o_orderstatus WHEN 'F' THEN 'R' WHEN 'O' THEN 'S' ELSE 'I' END AS test_result, o_orderkey % 13 = 0 AS staging
FROM {orders}"""
VIEWS["pdstest_category"] = """
SELECT * FROM (
 SELECT drug_id, medium_id, method_id, concentration,
  CASE CAST(drug_id + 2 * coalesce(medium_id, 0) + 3 * coalesce(method_id, 0) + 2 * coalesce(concentration, 0) AS INT) % 7
   WHEN 0 THEN 'WHO_current' WHEN 1 THEN 'WHO_past' WHEN 2 THEN 'WHO_undefined' WHEN 3 THEN 'non_WHO_CC' WHEN 4 THEN 'to_be_excluded' END AS category
 FROM (SELECT DISTINCT drug_id, medium_id, method_id, concentration FROM {pdstest} WHERE coalesce(concentration, 1) > 0) k) c
WHERE category IS NOT NULL"""
VIEWS["categorised_test"] = """
SELECT test_id, sample_id, drug_id, medium_id, method_id, concentration, test_result,
 split_part('WHO_current,non_WHO_CC_SR,WHO_past,WHO_undefined,non_WHO_CC_R,non_WHO_CC_S,to_be_excluded,non_WHO_CC', ',', CAST(test_id % 8 + 1 AS INT)) AS phenotypic_category
FROM {pdstest}"""
VIEWS["mictest"] = """
SELECT l_orderkey * 10 + l_linenumber AS id, CAST(o_custkey AS INT) AS sample_id, CAST(l_partkey % 25 + 1 AS INT) AS drug_id,
 split_part('UKMYC5,UKMYC6,MYCOTB,MGIT,7H10,LJ', ',', CAST(l_suppkey % 6 + 1 AS INT)) AS plate,
 split_part('(0,0.25] (0.25,0.5] (0.5,1] [1,1] (2,) (0.25,1] [0.08,0.08] (,0.5]', ' ', CAST(l_quantity AS INT) % 8 + 1) AS mic_value, l_suppkey AS package_id, l_linenumber = 7 AS staging
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
VIEWS["cutoff"] = "SELECT DISTINCT drug_id, plate AS medium_name, CAST(1 + drug_id % 4 AS DOUBLE) / 4 AS value FROM {mictest}"
VIEWS["plate_concentration"] = """
SELECT plate, drug_id, 0.25e0 AS concentration FROM (SELECT DISTINCT plate, drug_id FROM {mictest}) a
UNION ALL SELECT plate, drug_id, 0.5e0 FROM (SELECT DISTINCT plate, drug_id FROM {mictest}) b
UNION ALL SELECT plate, drug_id, 1.0e0 FROM (SELECT DISTINCT plate, drug_id FROM {mictest}) c WHERE drug_id % 3 <> 0"""
VIEWS["binarised"] = """
SELECT id AS mictest_id, sample_id, drug_id, plate, mic_value, CASE WHEN sample_id % 40 = 3 THEN NULL WHEN id % 20 < 3 THEN 'R' ELSE 'S' END AS test_result,
 CASE WHEN plate = 'MYCOTB' THEN 'MYCOTB_MIC' WHEN plate LIKE 'UKMYC%' THEN 'CRyPTIC_MIC' ELSE 'to_be_excluded' END AS phenotypic_category FROM {mictest}"""


def _names(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(text) if name})


class Inputs:
    """Views and tables of one data folder as lazily built DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._built, self._of_cohort = spark, folder, {}, None

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in VIEWS:
                self._built[name] = self.sql(VIEWS[name])
            elif name in TABLES:
                self._built[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                raise AttributeError(name)
        return self._built[name]

    def of_cohort(self) -> Inputs:
        """The same tables, of the orders those of the cohort's samples.  Every call hangs on an order and every order on a sample, so ``genotype`` and
        ``locus_stats`` of these are the cohort's rows; the other samples' go before they are dealt out."""
        if self._of_cohort is None:
            self._of_cohort = Inputs(self.spark, self.folder)
            samples = self.cohort.select(F.col("sample_id").cast("long").alias("__sample"))
            self._of_cohort._built["orders"] = self.orders.join(samples, F.col("o_custkey") == F.col("__sample"), "left_semi")
        return self._of_cohort

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: getattr(self, name) for name in _names(text)})


def render(text: str) -> str:
    """A query over views as one self-contained DuckDB statement."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in _names(body):
            if name in VIEWS and name not in order:
                visit(VIEWS[name])
                order.append(name)

    visit(text)
    prefix = {name: f"v_{name}" for name in order}

    def filled(body: str) -> str:
        return body.format(**{name: prefix.get(name, name) for name in _names(body)}).replace("`", '"')

    if not order:
        return filled(text)
    views = ",\n".join(f"{prefix[name]} AS ({filled(VIEWS[name])})" for name in order)
    body = filled(text).strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
