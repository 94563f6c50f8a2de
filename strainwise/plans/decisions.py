"""Cohort, classification, prediction, lineage and matrix queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainwise.operators import classify, cohort, lineage, matrix, predict
from strainwise.plans.registry import query
from strainwise.session import cut_lineage

# ------------------------------------------------------------------ cohort


@query("qc_samples", "SELECT c.sample_id FROM {cohort} c WHERE EXISTS (SELECT 1 FROM {clean_phenotype} p WHERE p.sample_id = c.sample_id)")
def _(t):
    return cohort.qc_samples(t.sequencing, t.summary_stats, t.clean_phenotype)


BOXES = """SELECT p.sample_id, d.drug_name, p.phenotype, p.phenotypic_category AS box, CASE WHEN p.phenotypic_category IN ('WHO_current', 'non_WHO_CC_SR', 'WHO_past') THEN 'WHO' WHEN p.phenotypic_category LIKE 'CC-ATU%' THEN 'CC-ATU' WHEN p.phenotypic_category LIKE 'CC%' THEN 'CC' ELSE 'ALL' END AS phenotypic_category
FROM {clean_phenotype} p JOIN {cohort} c ON c.sample_id = p.sample_id JOIN {drug} d ON d.drug_id = p.drug_id"""


def boxes(t):
    return cohort.phenotype_boxes(t.clean_phenotype, t.cohort, t.drug)


@query("phenotype_boxes", BOXES)
def _(t):
    return boxes(t)


@query(
    "drug_overview",
    f"""WITH c AS (SELECT drug_name, CASE WHEN phenotypic_category = 'ALL' THEN 'not-WHO' ELSE phenotypic_category END AS category, phenotype, CAST(count(DISTINCT sample_id) AS BIGINT) AS n FROM ({BOXES}) b GROUP BY 1, 2, 3),
u AS (SELECT drug_name, category, phenotype, n FROM c UNION ALL SELECT drug_name, 'ALL', phenotype, CAST(sum(n) AS BIGINT) FROM c WHERE category IN ('WHO', 'not-WHO') GROUP BY 1, 3),
p AS (SELECT drug_name, category AS phenotypic_category, CAST(sum(n) FILTER (WHERE phenotype = 'R') AS BIGINT) AS R, CAST(sum(n) FILTER (WHERE phenotype = 'S') AS BIGINT) AS S FROM u GROUP BY 1, 2)
SELECT *, R + S AS total, round(100.0 * (CAST(R AS DOUBLE) / (R + S)), 6) AS res_percentage, round(100 * (CAST(R AS DOUBLE) / (R + S) - 1.96 * sqrt(CAST(R AS DOUBLE) / (R + S) * (1 - CAST(R AS DOUBLE) / (R + S)) / (R + S))), 6) AS interval_lower,
 round(100 * (CAST(R AS DOUBLE) / (R + S) + 1.96 * sqrt(CAST(R AS DOUBLE) / (R + S) * (1 - CAST(R AS DOUBLE) / (R + S)) / (R + S))), 6) AS interval_upper FROM p""",
)
def _(t):
    rounded = {c: F.round(c, 6) for c in ("res_percentage", "interval_lower", "interval_upper")}
    return cohort.drug_overview(boxes(t)).withColumns(rounded)


@query(
    "samples_per_country",
    """SELECT n.country_usual_name, n.three_letters_code, CAST(count(*) AS BIGINT) AS total FROM (SELECT c.sample_id, coalesce(s.country_id, a.country_id) AS country_id FROM {cohort} c LEFT JOIN {sample} s ON s.sample_id = c.sample_id
 LEFT JOIN (SELECT sample_id, min(country_id) AS country_id FROM {sample_alias} GROUP BY sample_id) a ON a.sample_id = c.sample_id) x LEFT JOIN {country} n ON n.three_letters_code = x.country_id GROUP BY 1, 2""",
)
def _(t):
    return cohort.samples_per_country(t.cohort, t.sample, t.sample_alias, t.country)


@query(
    "sample_identifiers",
    """SELECT c.sample_id, coalesce((SELECT string_agg(DISTINCT name, ', ' ORDER BY name) FROM {sample_alias} a WHERE a.sample_id = c.sample_id), '') AS names, coalesce((SELECT string_agg(DISTINCT fastq_prefix, ', ' ORDER BY fastq_prefix) FROM {sample_alias} a WHERE a.sample_id = c.sample_id), '') AS fastq_prefixes,
 coalesce((SELECT string_agg(DISTINCT library_name, ', ' ORDER BY library_name) FROM {sequencing} q WHERE q.sample_id = c.sample_id), '') AS library_names FROM {cohort} c""",
)
def _(t):
    return cohort.sample_identifiers(t.cohort, t.sample_alias, t.sequencing)


GENCAT = """SELECT g.sample_id, g.variant_id, g.quality, g.af, c.drug_id, c.tier, c.gene_db_crossref_id, c.variant_category, c.predicted_effect, c.position, c.distance_to_reference
FROM {genotype_af} g JOIN {cohort} s ON s.sample_id = g.sample_id JOIN {variant_category} c ON c.variant_id = g.variant_id WHERE g.genotyper IN ('freebayes', 'delly') AND g.af >= 0.25"""


def gencat(t):
    return cohort.categorised_genotypes(t.of_cohort().genotype, t.variant_category, t.cohort)


@query("categorised_genotypes", GENCAT)
def _(t):
    return gencat(t)


SAMPLE_DRUG = "SELECT p.sample_id, p.drug_id FROM {clean_phenotype} p JOIN {cohort} c ON c.sample_id = p.sample_id"
MISSING = f"""SELECT p.sample_id, p.drug_id, t.tier, t.gene_db_crossref_id FROM ({SAMPLE_DRUG}) p JOIN {{tier}} t ON t.drug_id = p.drug_id JOIN {{locus_stats}} l ON l.sample_id = p.sample_id AND l.gene_db_crossref_id = t.gene_db_crossref_id
WHERE l.coverage_10x < 1 AND NOT EXISTS (SELECT 1 FROM ({GENCAT}) g WHERE g.sample_id = p.sample_id AND g.gene_db_crossref_id = t.gene_db_crossref_id AND g.predicted_effect IN ('deletion', 'feature_ablation', 'frameshift', 'inframe_deletion'))"""


def sample_drug(t):
    return t.clean_phenotype.join(t.cohort, "sample_id", "left_semi").select("sample_id", "drug_id")


@query("missing_tier_samples", f"SELECT DISTINCT d.drug_name, m.sample_id, m.tier FROM ({MISSING}) m JOIN {{drug}} d ON d.drug_id = m.drug_id")
def _(t):
    return cohort.missing_tier_samples(sample_drug(t), gencat(t), t.of_cohort().locus_stats, t.tier, t.drug)


_POSITIONS = "SELECT gene_db_crossref_id, variant_category, predicted_effect, string_agg(DISTINCT CAST(position AS STRING), ';' ORDER BY CAST(position AS STRING)) AS position FROM {variant_category} GROUP BY 1, 2, 3"


def positions(t):
    from strainwise.operators.variants import category_positions

    return category_positions(t.variant_category)


def _extract(uncovered: bool) -> str:
    rest = f" UNION ALL SELECT sample_id, drug_id, tier, gene_db_crossref_id, NULL, NULL, NULL FROM ({MISSING}) m" if uncovered else ""
    return f"""SELECT d.drug_name, x.sample_id, x.tier, y.resolved_symbol, x.variant_category, p.predicted_effect, CAST(NULL AS STRING) AS neutral, x.max_af, x.max_quality, p.position
FROM (SELECT g.sample_id, g.drug_id, g.tier, g.gene_db_crossref_id, g.variant_category, max(g.af) AS max_af, max(g.quality) AS max_quality FROM ({GENCAT}) g JOIN ({SAMPLE_DRUG}) s ON s.sample_id = g.sample_id AND s.drug_id = g.drug_id GROUP BY 1, 2, 3, 4, 5{rest}) x
LEFT JOIN ({_POSITIONS}) p ON p.gene_db_crossref_id = x.gene_db_crossref_id AND p.variant_category = x.variant_category JOIN {{drug}} d ON d.drug_id = x.drug_id JOIN {{symbol}} y ON y.gene_db_crossref_id = x.gene_db_crossref_id"""


@query("genotype_extract", _extract(True))
def _(t):
    return cohort.genotype_extract(sample_drug(t), gencat(t), positions(t), t.of_cohort().locus_stats, t.drug, t.symbol, t.tier)


@query("genotype_extract_orphan", _extract(False))
def _(t):
    return cohort.genotype_extract(
        sample_drug(t), gencat(t), positions(t), t.locus_stats, t.drug, t.symbol, t.tier, with_uncovered=False
    )


@query("match_previous_catalogue", "SELECT DISTINCT s.resolved_symbol, c.variant_category, c.predicted_effect, i.v1_annotation AS description FROM {variant_info} i JOIN {variant} v ON v.position = i.position AND v.reference_nucleotide = i.reference_nucleotide AND v.alternative_nucleotide = i.alternative_nucleotide JOIN {variant_category} c ON c.variant_id = v.variant_id JOIN {symbol} s ON s.gene_db_crossref_id = c.gene_db_crossref_id")
def _(t):
    return cohort.match_previous_catalogue(t.variant_info, t.variant, t.variant_category, t.symbol)


@query("match_previous_grades", "SELECT s.resolved_symbol || '_' || c.variant_category AS variant, d.drug_name, g.grade FROM {variant_grade} g JOIN {variant_category} c ON c.variant_id = g.variant_id JOIN {drug} d ON d.drug_id = g.drug_id JOIN {symbol} s ON s.gene_db_crossref_id = c.gene_db_crossref_id WHERE g.grade_version = 2")
def _(t):
    return cohort.match_previous_grades(t.variant_grade, t.variant_category, t.drug, t.symbol)


_SINGLE_CATEGORY = """SELECT variant_id, resolved_symbol || '_' || category AS final_category, tier FROM (SELECT *, rank() OVER (PARTITION BY variant_id ORDER BY CASE WHEN category = 'lof' THEN 1 WHEN starts_with(category, 'c.') THEN 2 ELSE 3 END) AS rk FROM (
 SELECT f.variant_id, y.resolved_symbol, k.tier, CASE WHEN regexp_matches(f.predicted_effect, '(frameshift|stop_gained|start_lost)') THEN 'lof' WHEN f.predicted_effect LIKE '%stop_lost%' THEN 'stop_lost' WHEN f.predicted_effect = 'upstream_gene_variant' THEN coalesce(g.nucleotidic_annotation, f.nucleotidic_annotation) ELSE f.proteic_annotation END AS category
 FROM {fapg} f JOIN {tier} k ON k.gene_db_crossref_id = f.gene_db_crossref_id JOIN {drug} d ON d.drug_id = k.drug_id AND d.drug_name = 'Isoniazid' JOIN {symbol} y ON y.gene_db_crossref_id = f.gene_db_crossref_id
 LEFT JOIN {mnv} m ON m.mnv_id = f.variant_id AND f.predicted_effect = 'upstream_gene_variant' LEFT JOIN {fapg} g ON g.variant_id = m.snv_id AND g.gene_db_crossref_id = f.gene_db_crossref_id
 WHERE f.predicted_effect NOT IN ('downstream_gene_variant', 'synonymous_variant') AND NOT (f.predicted_effect = 'upstream_gene_variant' AND f.distance_to_reference > 200)) x) r WHERE rk = 1"""
_CONCAT_FIXED = _SINGLE_CATEGORY.replace("resolved_symbol || '_' || category AS", "concat_ws('_', resolved_symbol, category) AS")


def single_categories(t):
    return cohort.single_drug_categories(t.fapg, t.mnv, t.symbol, t.tier, t.drug, "Isoniazid")


@query("single_drug_categories", _CONCAT_FIXED)
def _(t):
    return single_categories(t)


@query(
    "single_drug_extract",
    f"""SELECT s.sample_id, s.phenotype, x.tier, x.final_category, x.max_percent_reads FROM (SELECT DISTINCT p.sample_id, p.phenotype FROM {{clean_phenotype}} p JOIN {{cohort}} c ON c.sample_id = p.sample_id WHERE p.drug_id = 1) s
LEFT JOIN (SELECT g.sample_id, c.tier, c.final_category, max(g.af) AS max_percent_reads FROM {{genotype_af}} g JOIN ({_CONCAT_FIXED}) c ON c.variant_id = g.variant_id WHERE g.genotyper = 'freebayes' AND g.quality > 100 GROUP BY 1, 2, 3) x ON x.sample_id = s.sample_id""",
)
def _(t):
    samples = t.clean_phenotype.where("drug_id = 1").join(t.cohort, "sample_id", "left_semi")
    return cohort.single_drug_extract(samples, t.genotype, single_categories(t))


# ------------------------------------------------------------------ classification
KEY = "gene_db_crossref_id, tier, variant_category, drug_id"
COUNTS = f"SELECT {KEY}, CAST(count(DISTINCT CASE WHEN phenotype = 'R' THEN sample_id END) AS BIGINT) AS R, CAST(count(DISTINCT CASE WHEN phenotype = 'S' THEN sample_id END) AS BIGINT) AS S FROM {{neutral_calls}} GROUP BY {KEY}"


@query("genotypes_for_neutral", "SELECT g.sample_id, g.variant_id, g.af AS percent_reads, c.drug_id, c.variant_category FROM {genotype_af} g JOIN {cohort} h ON h.sample_id = g.sample_id JOIN {variant_category} c ON c.variant_id = g.variant_id WHERE g.genotyper IN ('freebayes', 'delly') AND g.quality > 1000 AND g.af > 0.75")
def _(t):
    calls = classify.genotypes_for_neutral(t.genotype, t.cohort, t.variant_category)
    return calls.select("sample_id", "variant_id", "percent_reads", "drug_id", "variant_category")


@query("phenotype_counts", COUNTS)
def _(t):
    return classify.phenotype_counts(t.neutral_calls)


# Binomial tail in log space: the upper bound lies below x exactly when P(X <= R) < 0.025.
_TAIL = "list_sum(list_transform(generate_series(0, R), lambda k: exp(lgamma(R + S + 1) - lgamma(k + 1) - lgamma(R + S - k + 1) + k * ln({x}) + (R + S - k) * ln(1 - {x}))))"


def _below(x: str) -> str:
    return f"(S > 0 AND {_TAIL.replace('{x}', x)} < 0.025)"


@query("ppv", f"SELECT {KEY}, R, S, round(CAST(R AS DOUBLE) / (R + S), 9) AS PPV, {_below('0.1')} AS below_10, {_below('0.5')} AS below_50, {_below('0.9')} AS below_90 FROM ({COUNTS}) c")
def _(t):
    values = classify.ppv(classify.phenotype_counts(t.neutral_calls))
    return values.select(
        *classify.CATEGORY_KEY, "R", "S", F.round("PPV", 9).alias("PPV"),
        *[(F.col("Upper_PPV") < x).alias(f"below_{int(x * 100)}") for x in (0.1, 0.5, 0.9)],
    )


@query("udf_beta_upper", f"SELECT DISTINCT c_nationkey AS R, CAST(c_custkey % 50 AS INT) AS S, {_below('0.3').replace('R', 'c_nationkey').replace('S >', '(c_custkey % 50) >').replace('+ S', '+ c_custkey % 50')} AS below_30 FROM {{customer}}")
def _(t):
    from strainwise.functions.numeric import clopper_pearson_upper

    pairs = t.customer.select(F.col("c_nationkey").alias("R"), (F.col("c_custkey") % 50).cast("int").alias("S")).distinct()
    return pairs.select("R", "S", (clopper_pearson_upper("R", "S") < 0.3).alias("below_30"))


def _neutral(threshold: str) -> str:
    return f"SELECT {KEY}, 'A' AS \"set\" FROM ({COUNTS}) c WHERE {_below(threshold)}"


@query("neutral_below", _neutral("0.9"))
def _(t):
    values = classify.ppv(classify.phenotype_counts(t.neutral_calls))
    return classify.neutral_below(values, 0.9, "A").select(*classify.CATEGORY_KEY, "set")


@query("neutral_by_counts", _neutral("0.9"))
def _(t):
    return classify.neutral_by_counts(cut_lineage(classify.phenotype_counts(t.neutral_calls)), 0.9, "A")


@query("neutral_by_counts_low", _neutral("0.1"))
def _(t):
    return classify.neutral_by_counts(cut_lineage(classify.phenotype_counts(t.neutral_calls)), 0.1, "A")


@query("critical_steps", f"SELECT R, CAST(min(s) AS BIGINT) AS \"least_S\" FROM (SELECT DISTINCT c_nationkey AS R FROM {{customer}}) r, (SELECT unnest(generate_series(1, 400)) AS s) n WHERE {_below('0.3').replace('S > 0', 's > 0').replace('S', 's')} GROUP BY 1".replace("least_s", "least_S"))
def _(t):
    return classify.critical_steps(t.customer.select(F.col("c_nationkey").alias("R")), 0.3)


def _solo(source: str) -> str:
    return f"SELECT sample_id, drug_id, CASE WHEN a = 1 THEN 1 ELSE 2 END AS tier FROM (SELECT sample_id, drug_id, count(*) FILTER (WHERE tier = 1) AS a, count(*) FILTER (WHERE tier = 2) AS b FROM (SELECT DISTINCT sample_id, drug_id, tier, gene_db_crossref_id, variant_category FROM {source}) d GROUP BY 1, 2) s WHERE a = 1 OR (a = 0 AND b = 1)"


@query("solo_samples", _solo("{neutral_calls}"))
def _(t):
    return classify.solo_samples(t.neutral_calls)


MODAL = "SELECT gene_db_crossref_id, variant_category, position AS ModalPosition, predicted_effect AS Effect FROM (SELECT *, row_number() OVER (PARTITION BY gene_db_crossref_id, variant_category ORDER BY n DESC, position, predicted_effect) AS rn FROM (SELECT gene_db_crossref_id, variant_category, position, predicted_effect, count(DISTINCT sample_id) AS n FROM {neutral_calls} GROUP BY 1, 2, 3, 4) c) r WHERE rn = 1"


@query("modal_position", MODAL)
def _(t):
    return classify.modal_position(t.neutral_calls)


MARKED = r"""SELECT DISTINCT c.sample_id, c.drug_id FROM {neutral_calls} c JOIN {drug} d ON d.drug_id = c.drug_id JOIN {gene_name} g ON g.gene_db_crossref_id = c.gene_db_crossref_id WHERE
 (d.drug_name = 'Isoniazid' AND ((g.gene_name = 'inhA' AND c.variant_category IN ('c.-777C>T', 'p.Ser94Ala', 'c.-778A>G', 'c.-770T>C', 'c.-770T>A', 'c.-154G>A')) OR (g.gene_name = 'katG' AND starts_with(c.variant_category, 'p.Ser315'))))
 OR (d.drug_name = 'Rifampicin' AND g.gene_name = 'rpoB' AND (c.variant_category IN ('p.Val170Phe', 'p.Ile491Phe') OR (c.distance_to_reference BETWEEN 1278 AND 1356 AND c.predicted_effect <> 'synonymous_variant')))
 OR (d.drug_name = 'Ethambutol' AND g.gene_name = 'embB' AND c.variant_category IN ('p.Met306Ile', 'p.Met306Leu', 'p.Met306Val', 'p.Asp354Ala', 'p.Gly406Ala', 'p.Gly406Cys', 'p.Gly406Asp', 'p.Gly406Ser', 'p.Gln497Arg'))
 OR (d.drug_name = 'Pyrazinamide' AND g.gene_name = 'pncA' AND (c.variant_category = 'c.-11A>G' OR (NOT starts_with(c.variant_category, 'c.') AND c.variant_category NOT IN ('p.Ile6Leu', 'p.Leu35Arg'))))
 OR (d.drug_name IN ('Levofloxacin', 'Moxifloxacin') AND ((g.gene_name = 'gyrA' AND c.variant_category IN ('p.Gly88Ala', 'p.Gly88Cys', 'p.Asp89Asn', 'p.Ala90Val', 'p.Ser91Pro', 'p.Asp94Ala', 'p.Asp94Gly', 'p.Asp94His', 'p.Asp94Asn', 'p.Asp94Tyr')) OR (g.gene_name = 'gyrB' AND (c.variant_category = 'p.Ala504Val' OR (c.distance_to_reference BETWEEN 1491 AND 1506 AND c.predicted_effect <> 'synonymous_variant')))))
 OR (d.drug_name = 'Amikacin' AND ((g.gene_name = 'rrs' AND c.variant_category IN ('n.1401A>G', 'n.1402C>T', 'n.1484G>T')) OR (g.gene_name = 'eis' AND c.variant_category = 'c.-14C>T')))
 OR (d.drug_name = 'Streptomycin' AND ((g.gene_name = 'rrs' AND c.variant_category IN ('n.514A>C', 'n.517C>T', 'n.1484G>T')) OR (g.gene_name = 'rpsL' AND c.variant_category IN ('p.Lys43Arg', 'p.Lys88Gln', 'p.Lys88Arg'))))
 OR (d.drug_name = 'Ethionamide' AND ((g.gene_name = 'inhA' AND c.variant_category = 'p.Ser94Ala') OR (g.gene_name = 'fabG1' AND c.variant_category IN ('c.-15C>T', 'c.-16A>G', 'c.-8T>C', 'c.-8T>A', 'c.609G>A'))))
 OR (d.drug_name = 'Kanamycin' AND ((g.gene_name = 'rrs' AND c.variant_category IN ('n.1401A>G', 'n.1402C>T', 'n.1484G>T')) OR (g.gene_name = 'eis' AND c.variant_category IN ('c.-37G>T', 'c.-14C>T', 'c.-12C>T', 'c.-10G>A'))))
 OR (d.drug_name = 'Capreomycin' AND ((g.gene_name = 'rrs' AND c.variant_category IN ('n.1401A>G', 'n.1402C>T', 'n.1484G>T')) OR (g.gene_name = 'tlyA' AND c.variant_category = 'p.Asn236Lys')))"""


def gene_symbols(t):
    return t.gene_name.withColumnRenamed("gene_name", "gene_symbol")


@query("known_marker_samples", MARKED)
def _(t):
    return classify.known_marker_samples(t.neutral_calls, t.drug, gene_symbols(t))


def _neutral(threshold: str) -> str:
    below = _below(threshold)
    resistant = f"SELECT {KEY}, CAST(count(DISTINCT CASE WHEN phenotype = 'R' THEN sample_id END) AS BIGINT) AS R FROM {{0}} x GROUP BY {KEY}"

    def solo_set(remaining: str) -> str:
        left = f"(SELECT c.* FROM {{neutral_calls}} c WHERE (c.drug_id, c.gene_db_crossref_id, c.variant_category) IN (SELECT drug_id, gene_db_crossref_id, variant_category FROM {remaining}))"
        solo = _solo(f"(SELECT * FROM {left} l WHERE phenotype = 'R')")
        chosen = f"(SELECT l.* FROM {left} l JOIN ({solo}) o ON o.sample_id = l.sample_id AND o.drug_id = l.drug_id AND o.tier = l.tier)"
        return f"SELECT r.*, a.S FROM ({resistant.replace('{0}', chosen)}) r JOIN raw a USING ({KEY})"

    def without(remaining: str, label: str) -> str:
        return f"SELECT * FROM {remaining} m WHERE NOT EXISTS (SELECT 1 FROM {label} n WHERE n.drug_id = m.drug_id AND n.tier = m.tier AND n.gene_db_crossref_id = m.gene_db_crossref_id AND n.variant_category = m.variant_category)"

    return f"""WITH raw AS MATERIALIZED ({COUNTS}), set_a AS MATERIALIZED (SELECT * FROM raw WHERE {below}),
marked AS MATERIALIZED ({MARKED}),
count_b AS MATERIALIZED (SELECT {KEY}, CAST(count(DISTINCT CASE WHEN phenotype = 'R' THEN sample_id END) AS BIGINT) AS R, CAST(count(DISTINCT CASE WHEN phenotype = 'S' THEN sample_id END) AS BIGINT) AS S FROM {{neutral_calls}} c WHERE NOT EXISTS (SELECT 1 FROM marked k WHERE k.sample_id = c.sample_id AND k.drug_id = c.drug_id) GROUP BY {KEY}),
set_b AS MATERIALIZED (SELECT * FROM count_b WHERE {below}), cats AS MATERIALIZED (SELECT DISTINCT {KEY} FROM {{variant_category}}), rest_a AS ({without('cats', 'set_a')}), rest_ab AS MATERIALIZED ({without('rest_a', 'set_b')}),
count_d1 AS MATERIALIZED ({solo_set('rest_ab')}), set_d1 AS MATERIALIZED (SELECT * FROM count_d1 WHERE {below}), rest_d1 AS MATERIALIZED ({without('rest_ab', 'set_d1')}),
count_d2 AS MATERIALIZED ({solo_set('rest_d1')}), set_d2 AS MATERIALIZED (SELECT * FROM count_d2 WHERE {below}), rest_d2 AS MATERIALIZED ({without('rest_d1', 'set_d2')}),
set_m AS (SELECT DISTINCT m.* FROM rest_d2 m JOIN {{variant_category}} c USING ({KEY}) JOIN {{drug}} d ON d.drug_id = m.drug_id WHERE d.drug_name IN ('Pyrazinamide', 'Ethambutol', 'Rifampicin', 'Isoniazid') AND c.variant_id IN (SELECT variant_id FROM {{variant_info}}))
"""


def neutral(t, threshold):
    return classify.neutral_variants(
        t.cohort, t.clean_phenotype, t.variant_category, t.genotype, t.drug, gene_symbols(t), t.variant_info, threshold
    )


@query(
    "neutral_variants",
    _neutral("0.9")
    + f"SELECT {KEY}, 'A' AS \"set\" FROM set_a UNION ALL SELECT {KEY}, 'B' FROM set_b UNION ALL SELECT {KEY}, 'D1' FROM set_d1 UNION ALL SELECT {KEY}, 'D2' FROM set_d2 UNION ALL SELECT {KEY}, 'M' FROM set_m",
)
def _(t):
    return neutral(t, 0.9)[1].select(*classify.CATEGORY_KEY, "set")


@query(
    "neutral_ppv_table",
    _neutral("0.9")
    + f"SELECT {KEY}, a.R AS R_raw_setA, a.S AS S_raw_setA, b.R AS R_WKME_setB, b.S AS S_WKME_setB, c.R AS R_SOLO_setD1, c.S AS S_SOLO_setD1, d.R AS R_SOLO_setD2, d.S AS S_SOLO_setD2 FROM raw a LEFT JOIN count_b b USING ({KEY}) LEFT JOIN count_d1 c USING ({KEY}) LEFT JOIN count_d2 d USING ({KEY})",
)
def _(t):
    wide = neutral(t, 0.9)[0]
    return wide.select(*classify.CATEGORY_KEY, *[c for c in wide.columns if c.startswith(("R_", "S_"))])


@query(
    "neutral_report",
    f"""SELECT d.drug_name AS Drug, c.tier AS Tier, y.resolved_symbol AS Gene, l.rv_symbol AS LocusTag, c.variant_category AS Variant, m.Effect, m.ModalPosition, c.R, c.S
FROM ({COUNTS}) c JOIN {{drug}} d ON d.drug_id = c.drug_id JOIN {{symbol}} y ON y.gene_db_crossref_id = c.gene_db_crossref_id JOIN {{locus_tag}} l ON l.gene_db_crossref_id = c.gene_db_crossref_id JOIN ({MODAL}) m ON m.gene_db_crossref_id = c.gene_db_crossref_id AND m.variant_category = c.variant_category""",
)
def _(t):
    counts = classify.phenotype_counts(t.neutral_calls)
    return classify.neutral_report(counts, t.drug, t.symbol, t.locus_tag, classify.modal_position(t.neutral_calls))


# ------------------------------------------------------------------ prediction, first rules
_LOSS = "regexp_matches(predicted_effect, '(stop_gained|start_lost|frameshift_variant)')"
_ACCEPT = f"""(gene_name IN ('katG', 'pncA', 'tlyA', 'gid', 'ethA') AND {_LOSS}) OR (gene_name = 'katG' AND hgvs_value IN ('p.Ser315Thr', 'p.Ser315Asn', 'p.Trp328Leu')) OR (gene_name = 'fabG1' AND hgvs_value IN ('c.-16A>G', 'c.-15C>T', 'c.-8T>C', 'c.-8T>A', 'c.609G>A'))
 OR (gene_name = 'rpoB' AND predicted_effect <> 'synonymous_variant' AND (mii BETWEEN 426 AND 452 OR hgvs_value IN ('p.Val170Phe', 'p.Ile491Phe'))) OR (gene_name = 'pncA' AND predicted_effect = 'upstream_gene_variant' AND hgvs_value IN ('c.-12T>C', 'c.-11A>G', 'c.-11A>C', 'c.-11A>T', 'c.-7T>C', 'c.-5delG'))
 OR (gene_name = 'pncA' AND predicted_effect NOT IN ('upstream_gene_variant', 'downstream_gene_variant', 'synonymous_variant', 'initiator_codon_variant', 'stop_retained_variant') AND hgvs_value NOT IN ('p.Ile6Leu', 'p.Glu15Gly', 'p.Val21Ala', 'p.Leu35Arg', 'p.Ser66Leu', 'p.Ala79Thr', 'p.Ala79Val', 'p.Thr87Met', 'p.Thr114Met', 'p.Asp136Asn', 'p.Thr168Ile', 'p.Ala171Val'))
 OR (gene_name = 'eis' AND hgvs_value IN ('c.-14C>T', 'c.-8delC', 'c.-10G>A', 'c.-12C>T', 'c.-37G>T')) OR (gene_name = 'rrs' AND hgvs_value IN ('n.1401A>G', 'n.1402C>T', 'n.1484G>T', 'n.517C>T', 'n.514A>C', 'n.878G>A'))
 OR (gene_name = 'gyrA' AND hgvs_value IN ('p.Gly88Cys', 'p.Gly88Ala', 'p.Ala90Val', 'p.Ser91Pro')) OR (gene_name = 'embB' AND hgvs_value IN ('p.Met306Val', 'p.Met306Ile', 'p.Met306Leu')) OR (gene_name = 'inhA' AND hgvs_value = 'p.Ser94Ala')"""
# In the derived data no other listed change of the remaining genes occurs.
RULED = f"""SELECT a.variant_id, coalesce(k.drug, x.drug) AS drug, a.gene_name = 'pncA' AND a.predicted_effect <> 'upstream_gene_variant' AND NOT {_LOSS} AS with_rifampicin, a.gene_name, a.hgvs_value
FROM (SELECT * FROM {{preferred_annotation}} WHERE {_ACCEPT}) a
LEFT JOIN (VALUES ('katG', 'Isoniazid'), ('fabG1', 'Isoniazid'), ('fabG1', 'Ethionamide'), ('inhA', 'Ethionamide'), ('ethA', 'Ethionamide'), ('rpoB', 'Rifampicin'), ('pncA', 'Pyrazinamide'), ('gyrA', 'Levofloxacin'), ('gyrA', 'Moxifloxacin'), ('gyrB', 'Levofloxacin'), ('gyrB', 'Moxifloxacin'), ('tlyA', 'Capreomycin'), ('ddn', 'Delamanid'), ('rplC', 'Linezolid'), ('rpsL', 'Streptomycin'), ('gid', 'Streptomycin'), ('embB', 'Ethambutol'), ('embA', 'Ethambutol')) k(gene, drug) ON k.gene = a.gene_name
LEFT JOIN (VALUES ('eis', 'Amikacin', 'c.-14C>T'), ('eis', 'Kanamycin', 'c.-14C>T'), ('rrs', 'Amikacin', 'n.1401A>G'), ('rrs', 'Capreomycin', 'n.1401A>G'), ('rrs', 'Kanamycin', 'n.1401A>G')) x(gene, drug, change) ON x.gene = a.gene_name AND x.change = a.hgvs_value"""


@query("rule_variants_v1", RULED)
def _(t):
    return predict.rule_variants_v1(t.preferred_annotation)


ANNOTATED = "SELECT DISTINCT s.id AS sample_id FROM {sample} s JOIN {sample_alias} a ON a.sample_id = s.id JOIN {package} p ON p.id = a.package_id JOIN {sequencing} q ON q.sample_id = s.id JOIN {locus_stats} l ON l.sample_id = s.id WHERE a.name <> 'TB03805142' AND s.bioanalysis_status = 'Annotated'"


@query("annotated_samples", ANNOTATED)
def _(t):
    return predict.annotated_samples(t.package, t.sample_alias, t.sample, t.sequencing, t.locus_stats)


LOST = f"""SELECT l.sample_id, CASE g.gene_name WHEN 'katG' THEN 'Isoniazid' WHEN 'pncA' THEN 'Pyrazinamide' WHEN 'tlyA' THEN 'Capreomycin' WHEN 'gid' THEN 'Streptomycin' ELSE 'Ethionamide' END AS drug, l.coverage_10x, g.gene_name, 'deletion' AS hgvs_value
FROM {{locus_stats}} l JOIN ({ANNOTATED}) s ON s.sample_id = l.sample_id JOIN {{gene_name}} g ON g.gene_db_crossref_id = l.gene_db_crossref_id WHERE g.gene_name IN ('pncA', 'katG', 'tlyA', 'gid', 'ethA') AND l.coverage_10x < 0.95"""


def annotated(t):
    return predict.annotated_samples(t.package, t.sample_alias, t.sample, t.sequencing, t.locus_stats)


@query("loss_by_coverage_v1", LOST)
def _(t):
    return predict.loss_by_coverage_v1(t.locus_stats, annotated(t), t.gene_name)


INTEREST = f"SELECT s.sample_id, v.drug, v.variant_id, v.with_rifampicin, v.gene_name, v.hgvs_value FROM ({ANNOTATED}) s JOIN {{genotype}} g ON g.sample_id = s.sample_id JOIN ({RULED}) v ON v.variant_id = g.variant_id WHERE g.genotyper = 'freebayes' AND (2 * g.alternative_ad > g.total_dp OR v.gene_name <> 'rrs')"


@query("genotypes_of_interest", INTEREST)
def _(t):
    return predict.genotypes_of_interest(t.genotype, annotated(t), predict.rule_variants_v1(t.preferred_annotation))


UNCOVERED = f"SELECT s.sample_id, d.drug FROM ({ANNOTATED}) s JOIN {{locus_stats}} l ON l.sample_id = s.sample_id JOIN {{gene_name}} g ON g.gene_db_crossref_id = l.gene_db_crossref_id, (VALUES ('Amikacin'), ('Capreomycin'), ('Kanamycin'), ('Streptomycin')) d(drug) WHERE g.gene_name = 'rrs' AND l.coverage_10x < 0.95 AND l.mean_depth < 15"


@query("uncovered_rrs", UNCOVERED)
def _(t):
    return predict.uncovered_rrs(t.locus_stats, annotated(t), t.gene_name)


@query(
    "predict_v1",
    f"""WITH s AS MATERIALIZED ({ANNOTATED}), goi AS MATERIALIZED ({INTEREST}), cov AS MATERIALIZED ({LOST}), unc AS MATERIALIZED (SELECT DISTINCT * FROM ({UNCOVERED}) u),
grid AS (SELECT s.sample_id, d.drug FROM s, (VALUES ('Rifampicin'), ('Isoniazid'), ('Pyrazinamide'), ('Amikacin'), ('Capreomycin'), ('Kanamycin'), ('Levofloxacin'), ('Moxifloxacin'), ('Linezolid'), ('Streptomycin'), ('Ethionamide'), ('Ethambutol')) d(drug)),
rows AS (SELECT k.sample_id, k.drug, g.with_rifampicin, c.coverage_10x, coalesce(c.gene_name, g.gene_name) AS gene, coalesce(c.hgvs_value, g.hgvs_value) AS change FROM grid k LEFT JOIN goi g ON g.sample_id = k.sample_id AND g.drug = k.drug LEFT JOIN cov c ON c.sample_id = k.sample_id AND c.drug = k.drug),
grouped AS (SELECT sample_id, drug, coalesce(bool_or(NOT with_rifampicin), false) OR bool_or(coverage_10x IS NOT NULL) AS resistant, count(*) FILTER (WHERE with_rifampicin) = count(*) AS companion, coalesce(string_agg(gene || '_' || change, ';' ORDER BY gene, change), '') AS variant FROM rows GROUP BY 1, 2)
SELECT a.sample_id, d.drug_id, 1 AS version, CASE WHEN a.resistant THEN 'R' WHEN a.companion AND r.resistant THEN 'R' WHEN u.drug IS NOT NULL THEN 'U' ELSE 'S' END AS resistance_flag, CASE WHEN a.companion AND NOT coalesce(r.resistant, false) THEN '' ELSE a.variant END AS variant
FROM grouped a LEFT JOIN grouped r ON a.drug = 'Pyrazinamide' AND r.drug = 'Rifampicin' AND r.sample_id = a.sample_id LEFT JOIN unc u ON u.sample_id = a.sample_id AND u.drug = a.drug LEFT JOIN {{drug}} d ON d.drug_name = a.drug""",
)
def _(t):
    samples = annotated(t)
    interest = predict.genotypes_of_interest(t.genotype, samples, predict.rule_variants_v1(t.preferred_annotation))
    loss = predict.loss_by_coverage_v1(t.locus_stats, samples, t.gene_name)
    return predict.predict_v1(samples, interest, loss, predict.uncovered_rrs(t.locus_stats, samples, t.gene_name), t.drug)


# ------------------------------------------------------------------ prediction, second rules


@query("min_grade_by_allele", "SELECT v.variant_id, g.drug_id, g.grade_version, min(g.grade) AS grade FROM {variant_grade} g JOIN {variant} v ON v.position = g.position AND v.reference_nucleotide = g.reference_nucleotide AND v.alternative_nucleotide = g.alternative_nucleotide WHERE g.grade_version = 2 GROUP BY 1, 2, 3")
def _(t):
    return predict.min_grade_by_allele(t.variant_grade, t.variant)


@query("named_categories", "SELECT variant_id, gene_db_crossref_id, drug_id, tier, variant_category, predicted_effect, distance_to_reference, resolved_symbol, variant_catalogue_name FROM {named_category}")
def _(t):
    return predict.named_categories(t.variant_category, t.gene_label)


_LOF = "predicted_effect IN ('start_lost', 'stop_gained', 'frameshift', 'feature_ablation')"
_PAIRS_LOF = "('katG', 'Isoniazid'), ('pncA', 'Pyrazinamide'), ('Rv0678', 'Bedaquiline'), ('pepQ', 'Bedaquiline'), ('Rv0678', 'Clofazimine'), ('pepQ', 'Clofazimine'), ('ddn', 'Delamanid'), ('fbiA', 'Delamanid'), ('fbiB', 'Delamanid'), ('fbiC', 'Delamanid'), ('fgd1', 'Delamanid'), ('Rv2983', 'Delamanid'), ('ddn', 'Pretomanid'), ('fbiA', 'Pretomanid'), ('fbiB', 'Pretomanid'), ('fbiC', 'Pretomanid'), ('fgd1', 'Pretomanid'), ('Rv2983', 'Pretomanid'), ('gid', 'Streptomycin'), ('ethA', 'Ethionamide'), ('ethA', 'Prothionamide'), ('tlyA', 'Capreomycin')"
GRADED = f"""SELECT c.variant_id, c.variant_catalogue_name, c.drug_id, g.grade FROM {{named_category}} c JOIN {{variant_grade}} g ON g.variant_id = c.variant_id AND g.drug_id = c.drug_id WHERE g.grade_version = 2 AND g.grade IN (1, 2)
UNION SELECT c.variant_id, c.variant_catalogue_name, c.drug_id, 2 FROM {{named_category}} c JOIN {{drug}} d ON d.drug_id = c.drug_id WHERE {_LOF} AND (c.resolved_symbol, d.drug_name) IN ({_PAIRS_LOF})
UNION SELECT c.variant_id, c.variant_catalogue_name, c.drug_id, 0 FROM {{named_category}} c JOIN {{drug}} d ON d.drug_id = c.drug_id WHERE {_LOF} AND (c.resolved_symbol, d.drug_name) IN (('mmpL5', 'Bedaquiline'), ('eis', 'Amikacin'), ('eis', 'Kanamycin'))
UNION SELECT variant_id, variant_catalogue_name, drug_id, 2 FROM {{named_category}} WHERE resolved_symbol = 'rpoB' AND predicted_effect NOT IN ('synonymous_variant', 'upstream_gene_variant') AND floor(1 + (distance_to_reference - 1) / 3) BETWEEN 426 AND 452 AND variant_id NOT IN (SELECT variant_id FROM {{variant_grade}} WHERE grade_version = 2 AND grade IN (1, 2))"""


def graded(t):
    return predict.graded_variants(t.named_category, t.variant_grade, t.drug)


@query("graded_variants", GRADED)
def _(t):
    return graded(t)


COVERED = "SELECT l.sample_id, d.drug_id, 1 AS grade, g.resolved_symbol || '_deletion' AS variant_catalogue_name FROM {locus_stats} l JOIN {gene_label} g ON g.gene_db_crossref_id = l.gene_db_crossref_id JOIN (VALUES ('katG', 'Isoniazid'), ('pncA', 'Pyrazinamide'), ('gid', 'Streptomycin'), ('ethA', 'Ethionamide'), ('ethA', 'Prothionamide'), ('tlyA', 'Capreomycin')) r(gene, drug) ON r.gene = g.resolved_symbol JOIN {drug} d ON d.drug_name = r.drug WHERE l.coverage_10x < 0.95"


@query("loss_by_coverage_v2", COVERED)
def _(t):
    return predict.loss_by_coverage_v2(t.locus_stats, t.gene_label, t.drug)


GRADES = f"""SELECT g.sample_id, v.drug_id, v.grade, CASE WHEN g.af < 0.75 THEN v.variant_catalogue_name || ' (' || CAST(g.af AS STRING) || ')' ELSE v.variant_catalogue_name END AS variant_catalogue_name FROM {{genotype_af}} g JOIN {{sample}} s ON s.sample_id = g.sample_id JOIN ({GRADED}) v ON v.variant_id = g.variant_id
WHERE g.genotyper IN ('freebayes', 'delly') AND (2 * g.alternative_ad > g.total_dp OR NOT (starts_with(v.variant_catalogue_name, 'rrs') OR starts_with(v.variant_catalogue_name, 'rrl'))) UNION ALL {COVERED}"""


def grades(t):
    return predict.sample_grades(t.genotype, t.sample, graded(t), predict.loss_by_coverage_v2(t.locus_stats, t.gene_label, t.drug))


@query("sample_grades", GRADES)
def _(t):
    return grades(t)


MUTATIONS = f"""SELECT r.sample_id, r.drug_id, m.grade, string_agg(DISTINCT r.variant_catalogue_name, '; ' ORDER BY r.variant_catalogue_name) AS mutation FROM ({GRADES}) r JOIN (SELECT sample_id, drug_id, min(grade) AS grade FROM ({GRADES}) g GROUP BY 1, 2) m ON m.sample_id = r.sample_id AND m.drug_id = r.drug_id AND (m.grade <> 0 OR r.grade = 0) GROUP BY 1, 2, 3"""


@query("min_grade_mutations", MUTATIONS)
def _(t):
    return predict.min_grade_mutations(grades(t))


UNCALLED = "SELECT DISTINCT l.sample_id, d.drug_id FROM {locus_stats} l JOIN {sample} s ON s.sample_id = l.sample_id JOIN {gene_label} g ON g.gene_db_crossref_id = l.gene_db_crossref_id JOIN (VALUES ('rrs', 'Amikacin'), ('rrs', 'Capreomycin'), ('rrs', 'Kanamycin'), ('rrs', 'Streptomycin'), ('rrl', 'Linezolid')) r(gene, drug) ON r.gene = g.resolved_symbol JOIN {drug} d ON d.drug_name = r.drug WHERE l.coverage_10x < 0.95 AND l.mean_depth < 15"


@query("uncalled_genes", UNCALLED)
def _(t):
    return predict.uncalled_genes(t.locus_stats, t.sample, t.gene_label, t.drug)


PREDICTED = f"""SELECT s.sample_id, d.drug_id, 2 AS version, CASE WHEN m.grade IN (1, 2) THEN 'R' WHEN u.sample_id IS NOT NULL THEN 'U' ELSE 'S' END AS resistance_flag, CASE WHEN m.grade IN (0, 1, 2) THEN m.mutation ELSE '' END AS variant
FROM (SELECT DISTINCT sample_id FROM {{locus_stats}}) s CROSS JOIN (SELECT drug_id FROM {{drug}} WHERE drug_name IN ('Amikacin', 'Bedaquiline', 'Capreomycin', 'Clofazimine', 'Delamanid', 'Ethambutol', 'Ethionamide', 'Isoniazid', 'Kanamycin', 'Levofloxacin', 'Linezolid', 'Moxifloxacin', 'Pretomanid', 'Prothionamide', 'Pyrazinamide', 'Rifampicin', 'Streptomycin')) d
LEFT JOIN ({MUTATIONS}) m ON m.sample_id = s.sample_id AND m.drug_id = d.drug_id LEFT JOIN ({UNCALLED}) u ON u.sample_id = s.sample_id AND u.drug_id = d.drug_id"""


def predicted(t):
    mutations = predict.min_grade_mutations(grades(t))
    uncalled = predict.uncalled_genes(t.locus_stats, t.sample, t.gene_label, t.drug)
    return predict.predict_v2(t.locus_stats, mutations, uncalled, t.drug)


@query("predict_v2", PREDICTED)
def _(t):
    return predicted(t)


@query(
    "prediction_export",
    """SELECT a.name AS sample_aliases_name, d.drug_name, p.phenotype AS resistance_flag, p.phenotypic_category AS variant FROM {clean_phenotype} p JOIN {sample} s ON s.id = p.sample_id JOIN {drug} d ON d.drug_id = p.drug_id
LEFT JOIN (SELECT sample_id, arg_min(name, id) AS name FROM {sample_alias} WHERE origin = 'BioSample' AND origin_label = 'Sample name' GROUP BY 1) a ON a.sample_id = s.id WHERE s.origin = 'NCBI' AND p.drug_id IN (1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 17, 18) AND coalesce(CASE WHEN p.sample_id % 3 = 0 THEN NULL ELSE 2 END, 1) = 2""",
)
def _(t):
    rows = t.clean_phenotype.select(
        (F.col("sample_id") * 100 + F.col("drug_id")).alias("id"), "sample_id", "drug_id",
        F.when(F.col("sample_id") % 3 != 0, 2).alias("version"),
        F.col("phenotype").alias("resistance_flag"), F.col("phenotypic_category").alias("variant"),
    )
    return predict.prediction_export(rows, t.sample, t.sample_alias, t.drug)


# ------------------------------------------------------------------ lineage and matrix


@query("assign_marker_variants", "SELECT v.variant_id, m.position, m.alternative_nucleotide, m.count_presence, m.lineage_id FROM {lineage_marker} m JOIN {variant} v ON v.position = m.position AND v.alternative_nucleotide = m.alternative_nucleotide WHERE length(v.reference_nucleotide) = 1")
def _(t):
    return lineage.assign_marker_variants(t.lineage_marker.withColumn("variant_id", F.lit(None).cast("int")), t.variant)


@query(
    "lineage_marker_frequencies",
    """SELECT x.sample_id, x.position, l.lineage_numbering, x.cents / 100.0 AS final_af FROM (SELECT s.sample_id, m.position, m.lineage_id, CASE WHEN m.count_presence THEN CAST(sum(coalesce(round(g.af * 100), 0)) AS DOUBLE) ELSE 100 - CAST(sum(coalesce(round(g.af * 100), 0)) AS DOUBLE) END AS cents
FROM {sample} s CROSS JOIN {lineage_marker} m LEFT JOIN {genotype_af} g ON g.sample_id = s.sample_id AND g.variant_id = m.variant_id AND g.genotyper = 'bcftools' GROUP BY s.sample_id, m.position, m.count_presence, m.lineage_id) x JOIN {lineage} l ON l.id = x.lineage_id WHERE x.cents > 0""",
)
def _(t):
    return lineage.lineage_marker_frequencies(t.lineage_marker, t.lineage, t.sample, t.genotype)


_MARKER_CALLS = "SELECT g.sample_id, m.position, m.lineage_id, m.count_presence, CAST(sum(coalesce(round(g.af * 100), 0)) AS DOUBLE) AS cents FROM {genotype_af} g JOIN {lineage_marker_all} m ON m.variant_id = g.variant_id WHERE g.genotyper = 'bcftools' AND g.sample_id IN (SELECT sample_id FROM {sample}) GROUP BY 1, 2, 3, 4"


@query(
    "lineage_marker_relation",
    f"SELECT sample_id, position, lineage_id, NOT count_presence AS replaces, CASE WHEN count_presence THEN cents ELSE 100 - cents END / 100.0 AS final_af FROM ({_MARKER_CALLS}) c UNION ALL SELECT NULL, position, lineage_id, NULL, 1.0 FROM (SELECT DISTINCT position, lineage_id FROM {{lineage_marker_all}} WHERE NOT count_presence) d",
)
def _(t):
    defaults, exceptions = lineage.marker_relation(t.lineage_marker_all, t.sample, t.genotype)
    return exceptions.unionByName(defaults, allowMissingColumns=True)


_REPEATS = "SELECT DISTINCT gene * 20 + 1 AS start_pos, gene * 20 + 20 AS end_pos FROM {gene_ids} WHERE gene % 25 = 22 OR (gene % 25 IN (23, 24) AND gene % 3 <> 2)"
_SITES = f"SELECT v.variant_id, v.position, v.reference_nucleotide, v.alternative_nucleotide FROM {{variant}} v WHERE length(v.reference_nucleotide) = 1 AND length(v.alternative_nucleotide) = 1 AND NOT EXISTS (SELECT 1 FROM ({_REPEATS}) r WHERE v.position BETWEEN r.start_pos - 50 AND r.end_pos + 50)"


def repeats(t):
    return matrix.repeat_intervals(t.seqfeature, t.seqfeature_dbxref, t.qualifier, t.term, t.location)


@query("repeat_intervals", _REPEATS)
def _(t):
    return repeats(t)


@query("snv_sites", _SITES)
def _(t):
    return matrix.snv_sites(t.variant, repeats(t))


_CLEAR = "SELECT g.sample_id, g.variant_id, CAST(g.alternative_ad AS DOUBLE) / g.total_dp AS dp FROM {genotype} g WHERE g.genotyper = 'bcftools' AND g.sample_id IN (SELECT sample_id FROM {cohort}) AND 4 * g.alternative_ad > 3 * g.total_dp"
_VARYING = f"SELECT position, CAST(n AS BIGINT) AS genotype_count FROM (SELECT s.position, count(DISTINCT c.sample_id) AS n FROM ({_CLEAR}) c JOIN ({_SITES}) s ON s.variant_id = c.variant_id GROUP BY 1) x WHERE n > 0 AND n < 0.99 * (SELECT count(*) FROM {{cohort}})"


def varying(t):
    calls = matrix.clear_calls(t.genotype, t.cohort)
    sites = matrix.snv_sites(t.variant, repeats(t))
    # Every position with a call counts as varying: the test calls are spread thinly over the sites.
    found = matrix.varying_positions(calls, sites, t.cohort, low=0.0)
    return calls, found, matrix.varying_variants(t.variant, found)


@query("varying_positions", _VARYING)
def _(t):
    return varying(t)[1].select("position", "genotype_count")


@query("allele_counts", f"SELECT s.position, s.reference_nucleotide, " + ", ".join(f"CAST(count(DISTINCT CASE WHEN s.alternative_nucleotide = '{b}' THEN c.sample_id END) AS BIGINT) AS {b}" for b in "ACGT") + f" FROM ({_CLEAR}) c JOIN ({_SITES}) s ON s.variant_id = c.variant_id GROUP BY 1, 2")
def _(t):
    return matrix.allele_counts(matrix.clear_calls(t.genotype, t.cohort), matrix.snv_sites(t.variant, repeats(t)))


_CODE = "CASE {0} WHEN 'A' THEN 1 WHEN 'C' THEN 2 WHEN 'G' THEN 3 ELSE 4 END"
_DENSE = f"""SELECT s.sample_id, v.position, CAST(coalesce(b.code, v.ref_code) AS INT) AS integer FROM {{cohort}} s CROSS JOIN (SELECT v.position, min({_CODE.replace('{0}', 'v.reference_nucleotide')}) AS ref_code FROM {{variant}} v JOIN ({_VARYING}) p ON p.position = v.position WHERE length(v.reference_nucleotide) = 1 GROUP BY 1) v
LEFT JOIN (SELECT c.sample_id, v.position, arg_max({_CODE.replace('{0}', 'v.alternative_nucleotide')}, c.dp) AS code FROM ({_CLEAR}) c JOIN {{variant}} v ON v.variant_id = c.variant_id GROUP BY 1, 2) b ON b.sample_id = s.sample_id AND b.position = v.position"""


@query("dense_genotype_calls", _DENSE)
def _(t):
    calls, _, variants = varying(t)
    return matrix.dense_genotype_calls(calls, variants, t.cohort)


@query("genotype_matrix", f"SELECT sample_id, string_agg(CAST(integer AS STRING), '' ORDER BY position) AS codes FROM ({_DENSE}) d GROUP BY 1")
def _(t):
    calls, _, variants = varying(t)
    rows = matrix.genotype_matrix(calls, variants, t.cohort)
    return rows.select("sample_id", F.array_join(F.col("codes").cast("array<string>"), "").alias("codes"))


# Places count the varying positions; only differences from the reference base are entries.
@query(
    "genotype_matrix_sparse",
    f"SELECT d.sample_id, CAST(p.place AS INT) AS place, d.integer AS code FROM ({_DENSE}) d JOIN (SELECT v.position, min({_CODE.replace('{0}', 'v.reference_nucleotide')}) AS ref_code, row_number() OVER (ORDER BY v.position) - 1 AS place FROM {{variant}} v JOIN ({_VARYING}) p ON p.position = v.position WHERE length(v.reference_nucleotide) = 1 GROUP BY 1) p ON p.position = d.position WHERE d.integer <> p.ref_code",
)
def _(t):
    calls, _, variants = varying(t)
    _, rows = matrix.sparse_matrix(calls, variants, t.cohort)
    return rows.select("sample_id", F.explode(F.arrays_zip("places", "codes")).alias("e")).select(
        "sample_id", F.col("e.places").alias("place"), F.col("e.codes").alias("code")
    )


@query("varying_positions_default", _VARYING.replace("n > 0 AND", "n > 0.01 * (SELECT count(*) FROM {cohort}) AND"))
def _(t):
    calls = matrix.clear_calls(t.genotype, t.cohort)
    found = matrix.varying_positions(calls, matrix.snv_sites(t.variant, repeats(t)), t.cohort)
    return found.select("position", "genotype_count")


@query("genotype_pca")
def _(t):
    calls, _, variants = varying(t)
    return matrix.genotype_pca(calls, variants, t.cohort, k=5)
