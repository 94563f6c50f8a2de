"""Laboratory phenotype queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from strainwise.functions import intervals
from strainwise.operators import phenotypes as ph
from strainwise.plans.registry import query

WHO = "SELECT * FROM (SELECT *, rank() OVER (PARTITION BY drug_id, method_id, medium_id ORDER BY CASE category WHEN 'WHO_current' THEN 1 ELSE 2 END) AS rk FROM {pdstest_category} WHERE category IN ('WHO_current', 'WHO_past')) w WHERE rk = 1"
AGAR = f"""SELECT w.drug_id, min(w.concentration) AS min_concentration, max(w.concentration) AS max_concentration FROM ({WHO}) w JOIN {{medium}} m ON m.medium_id = w.medium_id
LEFT JOIN {{method}} a ON a.method_id = w.method_id WHERE m.medium_name IN ('Middlebrook7H10', 'Middlebrook7H11') AND (a.method_name IS NULL OR a.method_name = 'Proportions') GROUP BY w.drug_id"""


@query("who_cutoffs", f"SELECT drug_id, medium_id, method_id, concentration, category FROM ({WHO}) x")
def _(t):
    return ph.who_cutoffs(t.pdstest_category)


@query("agar_cutoffs", f"SELECT a.*, m.medium_id FROM ({AGAR}) a, {{medium}} m WHERE m.medium_name = 'Agar'")
def _(t):
    return ph.agar_cutoffs(t.pdstest_category, t.medium, t.method)


# Existence tests instead of limits per key: an independent statement of the same rules.
CATEGORISED = f"""
SELECT p.test_id, p.sample_id, p.drug_id, p.medium_id, p.test_result,
 CASE WHEN d.drug_name = 'Moxifloxacin' AND m.medium_name = 'MGIT' AND p.concentration IN (0.5, 1) THEN 'non_WHO_CC_SR'
  WHEN c.category IN ('WHO_past', 'WHO_current', 'to_be_excluded') THEN c.category
  WHEN p.test_result = 'S' AND (EXISTS (SELECT 1 FROM ({WHO}) w LEFT JOIN {{method}} wa ON wa.method_id = w.method_id WHERE w.drug_id = p.drug_id AND coalesce(w.medium_id, 0) = coalesce(p.medium_id, 0) AND w.concentration > p.concentration
    AND (coalesce(w.method_id, 0) = coalesce(p.method_id, 0) OR (wa.method_name IS NULL AND a.method_name = 'Proportions') OR (a.method_name IS NULL AND wa.method_name = 'Proportions')))
   OR EXISTS (SELECT 1 FROM ({AGAR}) g WHERE g.drug_id = p.drug_id AND m.medium_name = 'Agar' AND (a.method_name IS NULL OR a.method_name = 'Proportions') AND g.min_concentration > p.concentration)) THEN 'non_WHO_CC_S'
  WHEN p.test_result = 'R' AND (EXISTS (SELECT 1 FROM ({WHO}) w LEFT JOIN {{method}} wa ON wa.method_id = w.method_id WHERE w.drug_id = p.drug_id AND coalesce(w.medium_id, 0) = coalesce(p.medium_id, 0) AND w.concentration < p.concentration
    AND (coalesce(w.method_id, 0) = coalesce(p.method_id, 0) OR (wa.method_name IS NULL AND a.method_name = 'Proportions') OR (a.method_name IS NULL AND wa.method_name = 'Proportions')))
   OR EXISTS (SELECT 1 FROM ({AGAR}) g WHERE g.drug_id = p.drug_id AND m.medium_name = 'Agar' AND (a.method_name IS NULL OR a.method_name = 'Proportions') AND g.max_concentration < p.concentration)) THEN 'non_WHO_CC_R'
  ELSE c.category END AS phenotypic_category, p.concentration, p.method_id
FROM {{pdstest}} p JOIN {{drug}} d ON d.drug_id = p.drug_id LEFT JOIN {{medium}} m ON m.medium_id = p.medium_id LEFT JOIN {{method}} a ON a.method_id = p.method_id
LEFT JOIN {{pdstest_category}} c ON c.drug_id = p.drug_id AND coalesce(c.medium_id, 0) = coalesce(p.medium_id, 0) AND coalesce(c.method_id, 0) = coalesce(p.method_id, 0) AND coalesce(c.concentration, 0) = coalesce(p.concentration, 0)"""


def categorised(t):
    return ph.categorise_tests(t.pdstest, t.pdstest_category, t.drug, t.medium, t.method)


@query("categorise_tests", f"SELECT test_id, sample_id, drug_id, test_result, phenotypic_category FROM ({CATEGORISED}) c")
def _(t):
    return categorised(t).select("test_id", "sample_id", "drug_id", "test_result", "phenotypic_category")


POOLED_ID = "CASE {0} WHEN 'Ofloxacin' THEN (SELECT drug_id FROM {{drug}} WHERE drug_name = 'Levofloxacin') WHEN 'Prothionamide' THEN (SELECT drug_id FROM {{drug}} WHERE drug_name = 'Ethionamide') ELSE {1} END"


def _pool(alias: str, column: str) -> str:
    return POOLED_ID.format(alias, column).replace("{{", "{").replace("}}", "}")


@query("pool_drugs", f"SELECT p.test_id, {_pool('d.drug_name', 'p.drug_id')} AS drug_id FROM {{pdstest}} p JOIN {{drug}} d ON d.drug_id = p.drug_id")
def _(t):
    return ph.pool_drugs(t.pdstest.select("test_id", "drug_id"), t.drug)


def _agreed(source: str, keys: str) -> str:
    return f"SELECT {keys}, min(test_result) AS test_result FROM ({source}) s GROUP BY {keys} HAVING count(DISTINCT test_result) = 1 AND min(test_result) IN ('R', 'S')"


MEDIUM_RANK = "CASE medium_name WHEN 'Middlebrook7H10' THEN 1 WHEN 'LJ' THEN 2 WHEN 'Middlebrook7H11' THEN 3 WHEN 'Agar' THEN 4 WHEN 'MGIT' THEN 5 WHEN 'MODS' THEN 6 WHEN 'BACTEC460' THEN 7 ELSE 8 END"
CATEGORY_RANK = "CASE phenotypic_category WHEN 'WHO_current' THEN 1 WHEN 'non_WHO_CC_SR' THEN 2 WHEN 'WHO_past' THEN 3 WHEN 'WHO_undefined' THEN 4 WHEN 'non_WHO_CC_R' THEN 5 WHEN 'non_WHO_CC_S' THEN 6 WHEN 'CRyPTIC_MIC' THEN 7 WHEN 'MYCOTB_MIC' THEN 8 END"


def by_medium(source: str) -> str:
    named = f"SELECT t.*, m.medium_name FROM ({source}) t LEFT JOIN {{medium}} m ON m.medium_id = t.medium_id WHERE t.phenotypic_category NOT IN ('to_be_excluded', 'non_WHO_CC')"
    agreed = _agreed(named, "sample_id, drug_id, phenotypic_category, medium_name")
    return f"SELECT sample_id, drug_id, phenotypic_category, test_result FROM (SELECT *, rank() OVER (PARTITION BY sample_id, drug_id, phenotypic_category ORDER BY {MEDIUM_RANK}) AS rk FROM ({agreed}) a) r WHERE rk = 1"


def by_category(source: str) -> str:
    kept = f"SELECT * FROM ({source}) t WHERE phenotypic_category NOT IN ('to_be_excluded', 'non_WHO_CC')"
    agreed = _agreed(kept, "sample_id, drug_id, phenotypic_category")
    return f"SELECT sample_id, drug_id, phenotypic_category, test_result AS phenotype FROM (SELECT *, rank() OVER (PARTITION BY sample_id, drug_id ORDER BY {CATEGORY_RANK} NULLS FIRST) AS rk FROM ({agreed}) a) r WHERE rk = 1"


@query("consensus_by_medium", by_medium("SELECT * FROM {categorised_test}"))
def _(t):
    return ph.consensus_by_medium(t.categorised_test, t.medium)


@query("consensus_by_category", by_category("SELECT * FROM {categorised_test}"))
def _(t):
    return ph.consensus_by_category(t.categorised_test)


LOWER = "TRY_CAST(regexp_extract(mic_value, '[(\\[](.*),(.*)[\\])]', 1) AS DOUBLE)"
UPPER = "TRY_CAST(regexp_extract(mic_value, '[(\\[](.*),(.*)[\\])]', 2) AS DOUBLE)"
MEDIA = "('UKMYC6', 'UKMYC5', 'MGIT', 'LJ', '7H10', '7H11', 'MYCOTB')"
ATU = f"""SELECT e.drug_id, e.medium_name, coalesce(s.lower_value, e.value / 2) AS value FROM {{cutoff}} e
LEFT JOIN (SELECT plate, drug_id, concentration, coalesce(lag(concentration) OVER (PARTITION BY plate, drug_id ORDER BY concentration), 0) AS lower_value FROM {{plate_concentration}} WHERE plate IN ('UKMYC6', 'UKMYC5', 'MYCOTB')) s
ON s.plate = e.medium_name AND s.drug_id = e.drug_id AND s.concentration = e.value WHERE e.medium_name IN {MEDIA}"""


def binarised(mic: str, cutoff: str) -> str:
    return f"""SELECT mictest_id, sample_id, drug_id, plate, mic_value, test_result,
 CASE WHEN plate = 'MYCOTB' THEN 'MYCOTB_MIC' WHEN plate IN ('UKMYC5', 'UKMYC6') THEN 'CRyPTIC_MIC' WHEN test_result IS NOT NULL THEN 'non_WHO_CC_' || test_result ELSE 'to_be_excluded' END AS phenotypic_category
FROM (SELECT m.id AS mictest_id, m.sample_id, m.drug_id, m.plate, m.mic_value, CASE WHEN {UPPER} <= c.value THEN 'S' WHEN {LOWER} >= c.value THEN 'R' END AS test_result
 FROM ({mic}) m JOIN {{drug}} d ON d.drug_id = m.drug_id LEFT JOIN ({cutoff}) c ON c.drug_id = m.drug_id AND c.medium_name = m.plate
 WHERE NOT (m.plate = 'MYCOTB' AND d.drug_name IN ('Capreomycin', 'Cycloserine', 'Para-Aminosalicylic Acid', 'Rifabutin', 'Streptomycin'))
  AND NOT (m.plate = 'MYCOTB' AND d.drug_name = 'Isoniazid' AND m.mic_value = '[0.08,0.08]')) b"""


ALL_MIC = "SELECT * FROM {mictest}"
PLAIN_CUTOFF = f"SELECT * FROM {{cutoff}} WHERE medium_name IN {MEDIA}"


@query("atu_cutoffs", ATU)
def _(t):
    return ph.atu_cutoffs(t.cutoff, t.plate_concentration)


@query("binarise_mic", binarised(ALL_MIC, PLAIN_CUTOFF))
def _(t):
    return ph.binarise_mic(t.mictest, t.cutoff, t.plate_concentration, t.drug)


@query("binarise_mic_atu", binarised(ALL_MIC, ATU))
def _(t):
    return ph.binarise_mic(t.mictest, t.cutoff, t.plate_concentration, t.drug, atu=True)


ALLOWED = """SELECT m.* FROM {mictest} m JOIN {drug} d ON d.drug_id = m.drug_id WHERE m.plate IN ('UKMYC5', 'UKMYC6')
 OR (m.plate = 'MYCOTB' AND d.drug_name IN ('Amikacin', 'Ethambutol', 'Isoniazid', 'Moxifloxacin', 'Ofloxacin', 'Rifampicin'))
 OR (m.plate = 'MGIT' AND d.drug_name IN ('Bedaquiline', 'Clofazimine', 'Linezolid', 'Moxifloxacin', 'Pretomanid'))
 OR (m.plate = '7H11' AND d.drug_name IN ('Bedaquiline', 'Moxifloxacin')) OR (m.plate = '7H10' AND d.drug_name = 'Linezolid') OR (m.plate = 'LJ' AND d.drug_name = 'Streptomycin')"""


@query("filter_plate_drug_rules", ALLOWED)
def _(t):
    return ph.filter_plate_drug_rules(t.mictest, t.drug)


@query(
    "reciprocal_semi",
    "SELECT 'a' AS side, test_id AS id FROM {pdstest} p WHERE EXISTS (SELECT 1 FROM {mictest} m WHERE m.sample_id = p.sample_id AND m.drug_id = p.drug_id) UNION ALL SELECT 'b', id FROM {mictest} m WHERE EXISTS (SELECT 1 FROM {pdstest} p WHERE p.sample_id = m.sample_id AND p.drug_id = m.drug_id)",
)
def _(t):
    a, b = ph.reciprocal_semi(t.pdstest, t.mictest)
    return a.select(F.lit("a").alias("side"), F.col("test_id").cast("long").alias("id")).unionByName(
        b.select(F.lit("b").alias("side"), "id")
    )


@query("relabel_categories", "SELECT mictest_id, 'CC-ATU_' || CASE WHEN phenotypic_category IN ('CRyPTIC_MIC', 'MYCOTB_MIC') THEN phenotypic_category ELSE 'WHO_MIC' END AS phenotypic_category FROM {binarised}")
def _(t):
    return ph.relabel_categories(t.binarised, "CC-ATU_").select("mictest_id", "phenotypic_category")


@query("normalise_plate_names", "SELECT n_name, CASE n_nationkey % 4 WHEN 0 THEN 'MYCOTB' WHEN 1 THEN 'UKMYC5' WHEN 2 THEN '7H10' ELSE 'LJ' END AS plate FROM {nation}")
def _(t):
    raw = F.split(F.lit("Sensititre MYCOTB|Sensititre Custom AST Plates YUKMYC5|Middlebrook7H10|LJ"), r"\|")
    return ph.normalise_plate_names(t.nation.select("n_name", raw[F.col("n_nationkey") % 4].alias("plate")))


def _pooled(source: str) -> str:
    return f"SELECT s.* EXCLUDE (drug_id), {_pool('d.drug_name', 's.drug_id')} AS drug_id FROM ({source}) s JOIN {{drug}} d ON d.drug_id = s.drug_id"


TIERED = "drug_id IN (SELECT drug_id FROM {tier})"
CLEAN = f"""SELECT * FROM ({by_category(
    "SELECT sample_id, drug_id, phenotypic_category, test_result FROM (" + by_medium(_pooled(f"SELECT * FROM ({CATEGORISED}) k WHERE phenotypic_category IS NOT NULL"))
    + ") a UNION ALL SELECT sample_id, drug_id, phenotypic_category, test_result FROM (" + _pooled(binarised(ALL_MIC, PLAIN_CUTOFF)) + ") b"
)}) z WHERE {TIERED}"""


def clean_phenotypes(t):
    return ph.clean_binary_phenotypes(
        t.pdstest, t.pdstest_category, t.drug, t.medium, t.method, t.mictest, t.cutoff, t.tier, t.plate_concentration
    )


@query("clean_binary_phenotypes", CLEAN)
def _(t):
    return clean_phenotypes(t)


def _cc(cutoff: str) -> str:
    return f"SELECT * FROM ({by_category(_pooled(binarised(ALLOWED, cutoff)))}) z WHERE {TIERED}"


_LABEL = "CASE WHEN x.phenotypic_category IN ('CRyPTIC_MIC', 'MYCOTB_MIC') THEN x.phenotypic_category ELSE 'WHO_MIC' END"
_SAME = "y.sample_id = x.sample_id AND y.drug_id = x.drug_id"


@query(
    "clean_cc_phenotypes",
    f"""WITH exact AS MATERIALIZED ({_cc(PLAIN_CUTOFF)}), lowered AS MATERIALIZED ({_cc(ATU)})
SELECT x.sample_id, x.drug_id, 'CC_' || {_LABEL} AS phenotypic_category, x.phenotype FROM exact x WHERE EXISTS (SELECT 1 FROM lowered y WHERE {_SAME})
UNION ALL SELECT x.sample_id, x.drug_id, 'CC-ATU_' || {_LABEL}, x.phenotype FROM lowered x WHERE EXISTS (SELECT 1 FROM exact y WHERE {_SAME})""",
)
def _(t):
    return ph.cc_phenotypes(t.mictest, t.drug, t.plate_concentration, t.cutoff, t.tier)


@query(
    "who_only_phenotypes",
    """SELECT sample_id, drug_id, min(test_result) AS phenotype FROM (SELECT *, rank() OVER (PARTITION BY sample_id, drug_id ORDER BY CASE phenotypic_category WHEN 'WHO_current' THEN 1 ELSE 2 END) AS rk FROM {categorised_test} WHERE phenotypic_category IN ('WHO_current', 'WHO_past')) r
WHERE rk = 1 GROUP BY sample_id, drug_id HAVING count(DISTINCT test_result) = 1 AND min(test_result) IN ('R', 'S')""",
)
def _(t):
    return ph.who_only_phenotypes(t.categorised_test)


@query(
    "test_count_report",
    """SELECT d.drug_name, CASE WHEN a.method_name IS NULL THEN m.medium_name WHEN m.medium_name IS NULL THEN a.method_name ELSE m.medium_name || ' (' || a.method_name || ')' END AS medium_name,
 c.concentration, c.test_result, c.phenotypic_category, CAST(count(*) AS BIGINT) AS count, 'pDST' AS type
FROM {categorised_test} c JOIN {drug} d ON d.drug_id = c.drug_id LEFT JOIN {medium} m ON m.medium_id = c.medium_id LEFT JOIN {method} a ON a.method_id = c.method_id WHERE c.test_result IN ('R', 'S') GROUP BY 1, 2, 3, 4, 5""",
)
def _(t):
    return ph.test_count_report(t.categorised_test, t.drug, t.medium, t.method)


@query("mic_count_report", "SELECT d.drug_name, 'MIC' AS type, plate, mic_value, test_result, phenotypic_category, CAST(count(*) AS BIGINT) AS count FROM {binarised} b JOIN {drug} d ON d.drug_id = b.drug_id GROUP BY 1, 2, 3, 4, 5, 6")
def _(t):
    return ph.mic_count_report(t.binarised, t.drug)


_COMPLETE = "SELECT m.package_id, b.drug_id, b.plate FROM {binarised} b JOIN {mictest} m ON m.id = b.mictest_id WHERE b.plate IN ('MGIT', 'LJ', '7H10', '7H11') GROUP BY 1, 2, 3 HAVING count(*) = count(b.test_result)"


@query("complete_panels", _COMPLETE)
def _(t):
    return ph.complete_panels(t.binarised, t.mictest)


@query(
    "recategorise_complete_panels",
    f"""SELECT d.drug_name, 'MIC' AS type, b.plate, b.mic_value, b.test_result, CASE WHEN c.package_id IS NULL THEN b.phenotypic_category ELSE 'WHO_current' END AS phenotypic_category, CAST(count(*) AS BIGINT) AS count
FROM {{binarised}} b JOIN {{mictest}} m ON m.id = b.mictest_id JOIN {{drug}} d ON d.drug_id = b.drug_id LEFT JOIN ({_COMPLETE}) c ON c.package_id = m.package_id AND c.drug_id = b.drug_id AND c.plate = b.plate GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _(t):
    return ph.mic_count_report(
        ph.recategorise_complete_panels(t.binarised, t.mictest), t.drug, "phenotypic_category_corrected"
    )


@query(
    "unbinarised_by_package",
    "SELECT m.package_id, p.name AS package_name, d.drug_name, d.drug_id, b.plate, CAST(count(*) AS BIGINT) AS count FROM {binarised} b JOIN {mictest} m ON m.id = b.mictest_id JOIN {drug} d ON d.drug_id = b.drug_id JOIN {package} p ON p.id = m.package_id WHERE b.test_result IS NULL OR b.test_result NOT IN ('R', 'S') GROUP BY 1, 2, 3, 4, 5",
)
def _(t):
    return ph.unbinarised_by_package(t.binarised, t.mictest, t.drug, t.package)


# MIC entries in all the ways laboratories type them, from the line items.
MIC_TEXT = """SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_quantity AS INT) AS n,
 CASE CAST(l_partkey % 9 AS INT) WHEN 0 THEN '(' || CAST(CAST(l_quantity AS INT) AS STRING) || ',5 , 99,0]' WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) WHEN 2 THEN '<=' || CAST(CAST(l_quantity AS INT) AS STRING) || ',25'
  WHEN 3 THEN '>' || CAST(CAST(l_quantity AS INT) AS STRING) WHEN 4 THEN '≥ ' || CAST(CAST(l_quantity AS INT) AS STRING) WHEN 5 THEN CAST(CAST(l_quantity AS INT) AS STRING) || 'or99' WHEN 6 THEN '<' || CAST(CAST(l_quantity AS INT) AS STRING) || '.50'
  WHEN 7 THEN CAST(CAST(l_quantity AS INT) AS STRING) || ',5-99' ELSE 'contaminated' END AS value,
 CASE WHEN l_suppkey % 2 = 0 THEN CAST(l_quantity AS DOUBLE) / 2 END AS lower_value FROM {lineitem}"""
_N = "CAST(n AS STRING)"


@query(
    "normalise_mic_text",
    f"""SELECT id, CASE WHEN value LIKE '(%' THEN '(' || {_N} || '.5,99.0]' WHEN lower_value IS NOT NULL THEN '(' || CAST(lower_value AS STRING) || ',' || value || ']' WHEN value = {_N} THEN '[' || {_N} || '.0,' || {_N} || '.0]'
 WHEN value LIKE '<=%' THEN '(0,' || {_N} || '.25]' WHEN value LIKE '<%' THEN '(0,' || {_N} || '.5)' WHEN value LIKE '>%' THEN '(' || {_N} || '.0,)' WHEN value LIKE '≥%' THEN '[' || {_N} || '.0,)'
 WHEN value LIKE '%or99' THEN '(' || {_N} || ',99]' WHEN value LIKE '%-99' THEN '(' || {_N} || '.5,99]' ELSE value END AS mic_value FROM ({MIC_TEXT}) m""",
)
def _(t):
    rows = t.sql(MIC_TEXT)
    return rows.select("id", intervals.canonical_interval(F.col("value"), F.col("lower_value")).alias("mic_value"))


@query("interval_struct", f"SELECT id, {LOWER} AS lo, {UPPER} AS hi, starts_with(mic_value, '[') AS lo_inc, ends_with(mic_value, ']') AS hi_inc FROM {{mictest}}")
def _(t):
    return t.mictest.select("id", intervals.interval_struct(F.col("mic_value")).alias("i")).select("id", "i.*")
