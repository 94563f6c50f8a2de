"""Generic operators on the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainwise import schemas
from strainwise.functions import numeric, text
from strainwise.operators import matrix, relational as rel
from strainwise.plans.registry import query
from strainwise.session import work_area
from strainwise.sources import sinks, tables
from strainwise.streaming import incremental

# ------------------------------------------------------------------ sources


@query("scan_table", "SELECT n_nationkey, n_name, n_regionkey FROM {nation}")
def _(t):
    return tables.scan_table(t.spark, "nation", t.folder)


@query(
    "scan_delimited",
    "SELECT sample_id, gene_db_crossref_id, coverage_10x, mean_depth FROM {locus_stats}",
)
def _(t):
    path = work_area(t.spark, "delimited")
    rows = t.locus_stats.select("sample_id", "gene_db_crossref_id", "coverage_10x", "mean_depth")
    rows.write.option("sep", "\t").option("compression", "gzip").csv(path)
    return tables.scan_delimited(
        t.spark, path, "sample_id int, gene_db_crossref_id int, coverage_10x double, mean_depth double", sep="\t"
    )


@query(
    "scan_typed_text",
    "SELECT id AS sample_id, country_id, bioanalysis_status FROM {sample}",
)
def _(t):
    path = work_area(t.spark, "typed")
    t.sample.select("id", "country_id", "bioanalysis_status").na.fill("NA").write.option("sep", "\t").option(
        "header", True
    ).csv(path)
    return tables.scan_typed_text(t.spark, path, "sample_id int, country_id string, bioanalysis_status string")


@query(
    "scan_keyless_tsv",
    "SELECT CAST(gene_db_crossref_id AS STRING) AS gene_id, rv_symbol AS transcript_id FROM {locus_tag}",
)
def _(t):
    path = work_area(t.spark, "keyless")
    t.locus_tag.write.option("sep", "\t").csv(path)
    return tables.scan_keyless_tsv(t.spark, path, ["gene_id", "transcript_id"])


_GFF_LINES = """
SELECT l.seqname || chr(9) || 'src' || chr(9) || l.feature || chr(9) || CAST(l.s AS STRING) || chr(9) || CAST(l.e AS STRING) || chr(9) || '.' || chr(9) || l.strand || chr(9) || '.' || chr(9) || l.attr AS value
FROM (
 SELECT 'chr1' AS seqname, 'gene' AS feature, g.gene_db_crossref_id * 20 + 1 AS s, g.gene_db_crossref_id * 20 + 20 AS e, CASE WHEN g.gene_db_crossref_id % 2 = 0 THEN '+' ELSE '-' END AS strand,
  'locus_tag=' || g.rv_symbol || ';Dbxref_GeneID=' || CAST(g.gene_db_crossref_id AS STRING) || ';gene=' || s.resolved_symbol || ';gene_synonym=syn' || CAST(g.gene_db_crossref_id % 3 AS STRING) AS attr
 FROM {locus_tag} g JOIN {symbol} s ON s.gene_db_crossref_id = g.gene_db_crossref_id
 UNION ALL SELECT 'chr1', 'transcript', gene * 20 + 1, gene * 20 + 20, '+', 'transcript_id=T' || CAST(gene AS STRING) || '.1;Dbxref_GeneID=' || CAST(gene AS STRING) FROM {gene_ids}
 UNION ALL SELECT 'chr1', 'exon', gene * 20 + 1, gene * 20 + 9, '+', 'transcript_id=T' || CAST(gene AS STRING) || '.1' FROM {gene_ids}
 UNION ALL SELECT 'chr1', 'exon', gene * 20 + 11, gene * 20 + 20, '+', 'transcript_id=T' || CAST(gene AS STRING) || '.1' FROM {gene_ids}
) l"""


def gff_features(t):
    return tables.parse_gff(t.sql(_GFF_LINES))


@query(
    "scan_gff_gtf",
    """SELECT 'chr1' AS contig, 'gene' AS feature, gene * 20 + 1 AS start, gene * 20 + 20 AS stop, 'Rv' || lpad(CAST(gene AS STRING), 4, '0') AS label FROM {gene_ids}
UNION ALL SELECT 'chr1', 'transcript', gene * 20 + 1, gene * 20 + 20, 'T' || CAST(gene AS STRING) || '.1' FROM {gene_ids}
UNION ALL SELECT 'chr1', 'exon', gene * 20 + 1, gene * 20 + 9, 'T' || CAST(gene AS STRING) || '.1' FROM {gene_ids}
UNION ALL SELECT 'chr1', 'exon', gene * 20 + 11, gene * 20 + 20, 'T' || CAST(gene AS STRING) || '.1' FROM {gene_ids}""",
)
def _(t):
    path = work_area(t.spark, "features")
    t.sql(_GFF_LINES).write.text(path)
    attribute = F.coalesce(
        F.try_element_at("attributes", F.lit("locus_tag")), F.try_element_at("attributes", F.lit("transcript_id"))
    )
    return tables.scan_gff_gtf(t.spark, path).select(
        "contig", "feature", "start", F.col("end").alias("stop"), attribute.alias("label")
    )


_REPORT_LINES = """
SELECT CAST(o_custkey AS INT) AS sample_id, 'SN' || chr(9) || 'raw total sequences:' || chr(9) || CAST(count(*) AS STRING) || chr(9) || '# all' AS value FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS INT), 'SN' || chr(9) || 'reads mapped:' || chr(9) || CAST(max(o_orderkey) AS STRING) FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS INT), 'SN' || chr(9) || 'average length:' || chr(9) || CAST(min(o_orderkey) % 100 AS STRING) || '.5' FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS INT), 'FFQ' || chr(9) || 'noise: 1' FROM {orders} GROUP BY o_custkey"""


@query(
    "scan_report_kv",
    """SELECT CAST(o_custkey AS INT) AS sample_id, 'raw total sequences' AS name, CAST(count(*) AS DOUBLE) AS number FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS INT), 'reads mapped', CAST(max(o_orderkey) AS DOUBLE) FROM {orders} GROUP BY o_custkey
UNION ALL SELECT CAST(o_custkey AS INT), 'average length', CAST(min(o_orderkey) % 100 AS DOUBLE) + 0.5 FROM {orders} GROUP BY o_custkey""",
)
def _(t):
    return tables.parse_report(t.sql(_REPORT_LINES))


@query(
    "scan_incremental",
    "SELECT o_orderkey, o_custkey FROM {orders}",
)
def _(t):
    """Two runs: the first takes the keys below the middle, the second what lies beyond the mark."""
    state = work_area(t.spark, "mark")
    keys = ["o_orderkey", "o_custkey"]
    half = t.orders.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    first, commit = incremental.scan_incremental(t.orders.where(F.col("o_orderkey") <= half), keys, state)
    taken = sinks_area(first.select(*keys), t)
    commit()
    second, _ = incremental.scan_incremental(t.orders, keys, state)
    return taken.unionByName(second.select(*keys))


@query("scan_incremental_late", "SELECT o_orderkey, o_custkey FROM {orders}")
def _(t):
    """Two runs: a third of the customers' orders arrive only for the second, spread over all keys below the mark."""
    state = work_area(t.spark, "seen")
    keys = ["o_orderkey", "o_custkey"]
    window = t.orders.agg(F.max("o_orderkey") - F.min("o_orderkey")).first()[0]
    first, commit = incremental.scan_with_late_rows(t.orders.where("o_custkey % 3 <> 0"), keys, state, window)
    commit()
    second, _ = incremental.scan_with_late_rows(t.orders, keys, state, window)
    return first.select(*keys).unionByName(second.select(*keys))


def sinks_area(df, t):
    """Write and read back."""
    path = work_area(t.spark, "rows")
    sinks.append_table(df, path)
    return t.spark.read.parquet(path)


# ------------------------------------------------------------------ sinks


@query("append_table", "SELECT r_regionkey, r_name FROM {region} UNION ALL SELECT r_regionkey, r_name FROM {region}")
def _(t):
    path = work_area(t.spark, "append")
    sinks.append_table(t.region, path)
    sinks.append_table(t.region, path)
    return t.spark.read.parquet(path)


@query("overwrite_truncate", "SELECT variant_id, drug_id, min(grade) AS grade FROM {variant_grade} GROUP BY variant_id, drug_id")
def _(t):
    root = work_area(t.spark, "snapshots")
    sinks.overwrite_truncate(t.variant_grade, root)
    current = sinks.read_snapshot(t.spark, root)
    sinks.overwrite_truncate(current.groupBy("variant_id", "drug_id").agg(F.min("grade").alias("grade")), root)
    return sinks.read_snapshot(t.spark, root)


@query("clear_staging", "SELECT sample_id, variant_id FROM {genotype} WHERE 1 = 0")
def _(t):
    root = work_area(t.spark, "staging")
    staged = t.genotype.select("sample_id", "variant_id")
    sinks.overwrite_truncate(staged, root)
    sinks.clear_staging(t.spark, root, staged.schema)
    return sinks.read_snapshot(t.spark, root)


@query(
    "write_partitioned_csv",
    "SELECT d.drug_name, CAST(c.tier AS INT) AS tier, c.variant_id, c.variant_category FROM {variant_category} c JOIN {drug} d ON d.drug_id = c.drug_id",
)
def _(t):
    path = work_area(t.spark, "extract")
    rows = t.variant_category.join(t.drug, "drug_id").select("drug_name", "tier", "variant_id", "variant_category")
    sinks.write_partitioned_csv(rows, path, ["drug_name", "tier"])
    schema = "variant_id int, variant_category string, drug_name string, tier int"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query("write_single_csv", "SELECT country_usual_name, three_letters_code, country_id FROM {country}")
def _(t):
    path = work_area(t.spark, "single")
    sinks.write_single_csv(t.country, path)
    schema = "country_id int, three_letters_code string, country_usual_name string"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query("write_report", "SELECT drug_name, CAST(count(*) AS BIGINT) AS tests FROM {pdstest} p JOIN {drug} d ON d.drug_id = p.drug_id GROUP BY drug_name")
def _(t):
    root = work_area(t.spark, "report")
    counts = t.pdstest.join(t.drug, "drug_id").groupBy("drug_name").agg(F.count(F.lit(1)).alias("tests"))
    sinks.write_report({"tests": counts, "countries": t.country}, root)
    return t.spark.read.schema("drug_name string, tests long").option("header", True).csv(f"{root}/tests")


@query("write_report_tables", "SELECT 'tests' AS report, drug_name AS name, CAST(count(*) AS BIGINT) AS number FROM {pdstest} p JOIN {drug} d ON d.drug_id = p.drug_id GROUP BY drug_name UNION ALL SELECT 'countries', three_letters_code, CAST(country_id AS BIGINT) FROM {country}")
def _(t):
    """Both tables of a report, as they are read back."""
    root = work_area(t.spark, "report")
    counts = t.pdstest.join(t.drug, "drug_id").groupBy("drug_name").agg(F.count(F.lit(1)).alias("number"))
    countries = t.country.select(F.col("three_letters_code").alias("name"), F.col("country_id").alias("number"))
    sinks.write_report({"tests": counts, "countries": countries}, root)
    reader = t.spark.read.schema("name string, number long").option("header", True)
    return reduce(DataFrame.unionByName, [
        reader.csv(f"{root}/{name}").select(F.lit(name).alias("report"), "name", "number") for name in ("tests", "countries")
    ])


@query(
    "align_to_schema",
    "SELECT CAST(sample_id AS INT) AS sample_id, CAST(drug_id AS INT) AS drug_id, CAST(NULL AS INT) AS version, TRY_CAST(mic_value AS STRING) AS resistance_flag, plate AS variant FROM {mictest}",
)
def _(t):
    shaped = t.mictest.withColumnsRenamed({"mic_value": "resistance_flag", "plate": "variant"})
    return sinks.align_to_schema(shaped, schemas.struct_type(schemas.PREDICTION))


@query("assert_schema", "SELECT sample_id, drug_id FROM {clean_phenotype}")
def _(t):
    from pyspark.sql.types import IntegerType

    kinds = {"sample_id": IntegerType(), "drug_id": IntegerType()}
    return sinks.assert_schema(t.clean_phenotype.select("sample_id", "drug_id"), kinds)


# Several rows for a sample, as many as its orders; one of them is taken whole.
_INCOMING = "SELECT 'S' || CAST(o_custkey AS STRING) AS sample_name, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'C' || lpad(CAST(o_orderkey % 25 AS STRING), 2, '0') END AS country_id, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'new' || CAST(o_orderkey % 10 AS STRING) END AS origin FROM {orders}"
_TAKEN = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample_name ORDER BY country_id NULLS FIRST, origin NULLS FIRST) AS n FROM ({_INCOMING}) i) r WHERE n = 1"


@query(
    "upsert_coalesce",
    f"""SELECT coalesce(n.sample_name, o.sample_name) AS sample_name, o.sample_id, o.sra_name, o.bioanalysis_status, coalesce(n.country_id, o.country_id) AS country_id, coalesce(n.origin, o.origin) AS origin
FROM {{sample}} o FULL JOIN ({_TAKEN}) n ON n.sample_name = o.sample_name""",
)
def _(t):
    return sinks.upsert_coalesce(t.sample, t.sql(_INCOMING), ["sample_name"], ["country_id", "origin"]).select(
        "sample_name", "sample_id", "sra_name", "bioanalysis_status", "country_id", "origin"
    )


@query(
    "insert_if_absent",
    "SELECT sample_id, drug_id FROM {clean_phenotype} UNION SELECT sample_id, drug_id FROM {mictest}",
)
def _(t):
    return sinks.insert_if_absent(
        t.clean_phenotype.select("sample_id", "drug_id"), t.mictest.select("sample_id", "drug_id"), ["sample_id", "drug_id"]
    )


@query(
    "replace_matching_rows",
    """SELECT sample_id, drug_id, medium_id, concentration, test_result, 'old' AS origin FROM {pdstest} p
WHERE NOT EXISTS (SELECT 1 FROM {categorised_test} n WHERE n.phenotypic_category = 'WHO_current' AND n.sample_id = p.sample_id AND n.drug_id = p.drug_id AND n.medium_id IS NOT DISTINCT FROM p.medium_id AND n.concentration IS NOT DISTINCT FROM p.concentration AND n.test_result = p.test_result)
UNION ALL SELECT sample_id, drug_id, medium_id, concentration, test_result, 'new' FROM {categorised_test} WHERE phenotypic_category = 'WHO_current'""",
)
def _(t):
    columns = ["sample_id", "drug_id", "medium_id", "concentration", "test_result"]
    old = t.pdstest.select(*columns, F.lit("old").alias("origin"))
    new = t.categorised_test.where("phenotypic_category = 'WHO_current'").select(*columns, F.lit("new").alias("origin"))
    return sinks.replace_matching_rows(old, new, columns)


@query(
    "transition_status",
    """SELECT id, CASE WHEN bioanalysis_status = 'Uploaded to S3' AND id IN (SELECT sample_id FROM {cohort}) THEN 'Annotated' ELSE bioanalysis_status END AS bioanalysis_status FROM {sample}""",
)
def _(t):
    batch = t.cohort.select(F.col("sample_id").alias("id"))
    return sinks.transition_status(t.sample.select("id", "bioanalysis_status"), batch, "Uploaded to S3", "Annotated")


@query(
    "export_variant_ids",
    "SELECT chromosome, position, variant_id, reference_nucleotide, alternative_nucleotide FROM {variant}",
)
def _(t):
    path = work_area(t.spark, "ids")
    sinks.export_variant_ids(t.variant, path)
    schema = "chromosome string, position int, variant_id int, reference_nucleotide string, alternative_nucleotide string"
    return tables.scan_delimited(t.spark, path, schema, sep="\t")


# ------------------------------------------------------------------ projections and filters


@query("apply_mapping", "SELECT CAST(l_orderkey AS INT) AS order_id, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag AS flag FROM {lineitem}")
def _(t):
    mapping = [("l_orderkey", "order_id", "int"), ("l_quantity", "quantity", "long"), ("l_returnflag", "flag", "string")]
    return rel.apply_mapping(t.lineitem, mapping)


@query("select_fields", "SELECT file_path, library_name, sample_id FROM {sequencing}")
def _(t):
    return rel.select_fields(t.sequencing, ["file_path", "dna_source", "library_name", "sample_id"])


@query("rename_field", "SELECT s_suppkey AS supplier_id, s_name FROM {supplier}")
def _(t):
    return rel.rename_field(t.supplier.select("s_suppkey", "s_name"), "s_suppkey", "supplier_id")


@query("drop_null_fields", "SELECT doc_id, quality FROM {labels}")
def _(t):
    return rel.drop_null_fields(t.labels.select("doc_id", "quality", F.lit(None).cast("int").alias("empty")))


@query("filter_pred", "SELECT test_id FROM {pdstest} WHERE medium_id IS NOT NULL AND test_result <> ''")
def _(t):
    return t.pdstest.where(F.col("medium_id").isNotNull() & (F.col("test_result") != "")).select("test_id")


@query(
    "filter_compare",
    "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_quantity >= 10 AND l_quantity < 40 AND NOT (l_returnflag = 'A') AND (l_extendedprice > 1000 OR l_tax <= 0.02) AND l_linestatus <> 'X'",
)
def _(t):
    keep = (
        (F.col("l_quantity") >= 10)
        & (F.col("l_quantity") < 40)
        & ~(F.col("l_returnflag") == "A")
        & ((F.col("l_extendedprice") > 1000) | (F.col("l_tax") <= 0.02))
        & (F.col("l_linestatus") != "X")
    )
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber")


@query("filter_isin", "SELECT id FROM {mictest} WHERE plate IN ('UKMYC5', 'UKMYC6')")
def _(t):
    return t.mictest.where(F.col("plate").isin("UKMYC5", "UKMYC6")).select("id")


@query("filter_not_isin", "SELECT test_id FROM {categorised_test} WHERE phenotypic_category NOT IN ('to_be_excluded', 'non_WHO_CC')")
def _(t):
    return t.categorised_test.where(~F.col("phenotypic_category").isin("to_be_excluded", "non_WHO_CC")).select("test_id")


@query("filter_between", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_discount BETWEEN 0.02 AND 0.05")
def _(t):
    return t.lineitem.where(F.col("l_discount").between(0.02, 0.05)).select("l_orderkey", "l_linenumber")


@query("filter_rlike", "SELECT variant_id, gene FROM {effect} WHERE regexp_matches(effect, '(stop_gained|start_lost|frameshift_variant)')")
def _(t):
    return t.effect.where(F.col("effect").rlike("(stop_gained|start_lost|frameshift_variant)")).select("variant_id", "gene")


@query("filter_startswith", "SELECT variant_id, drug_id FROM {named_category} WHERE starts_with(variant_catalogue_name, 'rrs')")
def _(t):
    return t.named_category.where(F.col("variant_catalogue_name").startswith("rrs")).select("variant_id", "drug_id")


@query("filter_null", "SELECT CAST(count(*) FILTER (WHERE medium_id IS NULL) AS BIGINT) AS missing, CAST(count(*) FILTER (WHERE medium_id IS NOT NULL) AS BIGINT) AS present FROM {pdstest}")
def _(t):
    missing = F.col("medium_id").isNull()
    return t.pdstest.agg(F.count_if(missing).alias("missing"), F.count_if(~missing).alias("present"))


@query(
    "case_when",
    "SELECT test_id, CASE WHEN medium_id = 1 THEN 1 WHEN medium_id = 2 THEN 2 WHEN concentration > 0.5 THEN 3 ELSE 8 END AS rank FROM {pdstest}",
)
def _(t):
    rules = [
        (F.col("medium_id") == 1, F.lit(1)),
        (F.col("medium_id") == 2, F.lit(2)),
        (F.col("concentration") > 0.5, F.lit(3)),
    ]
    return t.pdstest.select("test_id", text.first_match(rules, F.lit(8)).alias("rank"))


@query("coalesce_cols", "SELECT test_id, coalesce(medium_id, method_id, 0) AS first_id FROM {pdstest}")
def _(t):
    return t.pdstest.select("test_id", F.coalesce("medium_id", "method_id", F.lit(0)).alias("first_id"))


@query("fillna", "SELECT test_id, coalesce(medium_id, 0) AS medium_id, coalesce(method_id, 9) AS method_id, coalesce(concentration, -1) AS concentration FROM {pdstest}")
def _(t):
    chosen = t.pdstest.select("test_id", "medium_id", "method_id", "concentration")
    return rel.fill_by_column(chosen, {"medium_id": 0, "method_id": 9, "concentration": -1.0})


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM {events}")
def _(t):
    return t.events.select("user_id", "event_type").distinct()


@query("sample_fraction", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE CAST('0x' || substr(md5(concat(l_orderkey, '|', l_linenumber)), 1, 8) AS BIGINT) < 429496729")
def _(t):
    return rel.sample_by_key(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 0.1)


@query("literal_col", "SELECT n_nationkey, 2 AS version, CAST(NULL AS STRING) AS neutral FROM {nation}")
def _(t):
    return t.nation.select("n_nationkey", F.lit(2).alias("version"), F.lit(None).cast("string").alias("neutral"))


@query("rename_with_suffix", "SELECT r_regionkey, r_name AS r_name_raw_setA FROM {region}")
def _(t):
    return rel.rename_with_suffix(t.region, ["r_name"], "_raw_setA")


@query("literal_table", "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'near' WHEN 1 THEN 'near' END AS zone FROM {nation}")
def _(t):
    zones = tables.literal_table(t.spark, [(0, "near"), (1, "near")], "n_regionkey int, zone string")
    return t.nation.join(zones, "n_regionkey", "left").select("n_nationkey", "zone")


# ------------------------------------------------------------------ joins


@query("join_inner", "SELECT o_orderkey, c_name FROM {orders} JOIN {customer} ON c_custkey = o_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("join_left", "SELECT p.test_id, m.medium_name FROM {pdstest} p LEFT JOIN {medium} m ON m.medium_id = p.medium_id")
def _(t):
    return t.pdstest.join(t.medium, "medium_id", "left").select("test_id", "medium_name")


@query("join_left_semi", "SELECT id, plate FROM {mictest} m WHERE EXISTS (SELECT 1 FROM {clean_phenotype} c WHERE c.sample_id = m.sample_id AND c.drug_id = m.drug_id)")
def _(t):
    return rel.key_exists(t.mictest, t.clean_phenotype, ["sample_id", "drug_id"]).select("id", "plate")


@query("join_left_anti", "SELECT id, plate FROM {mictest} m WHERE NOT EXISTS (SELECT 1 FROM {clean_phenotype} c WHERE c.sample_id = m.sample_id AND c.drug_id = m.drug_id)")
def _(t):
    return rel.key_absent(t.mictest, t.clean_phenotype, ["sample_id", "drug_id"]).select("id", "plate")


@query("join_cross", "SELECT c_custkey, r_name FROM {customer} CROSS JOIN {region}")
def _(t):
    return rel.pair_all(t.customer.select("c_custkey"), t.region.select("r_name"), "c_custkey")


@query(
    "join_null_equal",
    "SELECT p.test_id, c.category FROM {pdstest} p LEFT JOIN {pdstest_category} c ON c.drug_id = p.drug_id AND coalesce(c.medium_id, 0) = coalesce(p.medium_id, 0) AND coalesce(c.method_id, 0) = coalesce(p.method_id, 0) AND coalesce(c.concentration, 0) = coalesce(p.concentration, 0)",
)
def _(t):
    keys = ["medium_id", "method_id", "concentration"]
    right = t.pdstest_category.select("drug_id", *[F.coalesce(k, F.lit(0)).alias(f"_{k}") for k in keys], "category")
    left = t.pdstest.select("test_id", "drug_id", *[F.coalesce(k, F.lit(0)).alias(f"_{k}") for k in keys])
    return left.join(right, ["drug_id", *[f"_{k}" for k in keys]], "left").select("test_id", "category")


@query(
    "join_inequality",
    "SELECT p.test_id, c.concentration AS below FROM {pdstest} p LEFT JOIN {pdstest_category} c ON c.drug_id = p.drug_id AND c.medium_id = p.medium_id AND c.concentration < p.concentration AND p.test_result = 'R'",
)
def _(t):
    p, c = t.pdstest.alias("p"), t.pdstest_category.alias("c")
    condition = (
        (F.col("c.drug_id") == F.col("p.drug_id"))
        & (F.col("c.medium_id") == F.col("p.medium_id"))
        & (F.col("c.concentration") < F.col("p.concentration"))
        & (F.col("p.test_result") == "R")
    )
    return p.join(c, condition, "left").select("test_id", F.col("c.concentration").alias("below"))


@query(
    "join_range_between",
    "SELECT e.variant_id, e.gene, p.start AS range_start FROM {effect} e JOIN {promoter} p ON p.gene_db_crossref_id = e.gene AND e.dist BETWEEN p.start AND p.`end`",
)
def _(t):
    inside = (F.col("gene") == F.col("gene_db_crossref_id")) & F.col("dist").between(F.col("start"), F.col("end"))
    return t.effect.join(t.promoter, inside).select("variant_id", "gene", F.col("start").alias("range_start"))


@query(
    "exclude_intervals",
    "SELECT v.variant_id, v.position FROM {variant} v WHERE NOT EXISTS (SELECT 1 FROM {location} l WHERE l.strand = 1 AND v.position BETWEEN l.start_pos - 3 AND l.end_pos + 3)",
)
def _(t):
    intervals = t.location.where("strand = 1").select("start_pos", "end_pos")
    return rel.exclude_intervals(t.variant.select("variant_id", "position"), intervals, pad=3, width=64)


@query(
    "join_or_condition",
    """SELECT c.variant_id, c.drug_id FROM {variant_category} c WHERE NOT EXISTS (SELECT 1 FROM {location} l WHERE l.seqfeature_id = c.gene_db_crossref_id * 10
AND ((c.position = l.end_pos - 2 AND c.predicted_effect = 'missense_variant') OR (c.position - l.end_pos IN (-2, -1) AND c.predicted_effect = 'frameshift') OR c.position = l.start_pos))""",
)
def _(t):
    c, stop = t.variant_category, t.location
    place, effect = F.col("position"), F.col("predicted_effect")
    hit = (F.col("seqfeature_id") == F.col("gene_db_crossref_id") * 10) & (
        ((place == F.col("end_pos") - 2) & (effect == "missense_variant"))
        | ((place - F.col("end_pos")).isin(-2, -1) & (effect == "frameshift"))
        | (place == F.col("start_pos"))
    )
    return c.join(stop, hit, "left_anti").select("variant_id", "drug_id")


@query("join_self", "SELECT a.variant_id, a.annotation_id AS first_id, b.annotation_id AS second_id FROM {annotation_link} a JOIN {annotation_link} b ON a.variant_id = b.variant_id AND a.annotation_id < b.annotation_id")
def _(t):
    a, b = t.annotation_link.alias("a"), t.annotation_link.alias("b")
    pairs = (F.col("a.variant_id") == F.col("b.variant_id")) & (F.col("a.annotation_id") < F.col("b.annotation_id"))
    return a.join(b, pairs).select(
        "a.variant_id", F.col("a.annotation_id").alias("first_id"), F.col("b.annotation_id").alias("second_id")
    )


@query(
    "join_allele_key",
    "SELECT i.v1_annotation, v.variant_id FROM {variant_info} i JOIN {variant} v ON v.position = i.position AND v.reference_nucleotide = i.reference_nucleotide AND v.alternative_nucleotide = i.alternative_nucleotide",
)
def _(t):
    alleles = ["position", "reference_nucleotide", "alternative_nucleotide"]
    return t.variant_info.drop("variant_id").join(t.variant, alleles).select("v1_annotation", "variant_id")


@query(
    "join_expression_key",
    "SELECT v.variant_id, l.seqfeature_id FROM {variant} v JOIN {location} l ON l.start_pos = v.position AND length(v.reference_nucleotide) = l.end_pos - l.start_pos - 16",
)
def _(t):
    spans = t.location.select("seqfeature_id", F.col("start_pos").alias("position"), (F.col("end_pos") - F.col("start_pos") - 16).alias("span"))
    return t.variant.withColumn("span", F.length("reference_nucleotide")).join(spans, ["position", "span"]).select("variant_id", "seqfeature_id")


@query("join_optional", "SELECT p.test_id, m.medium_name, CAST(NULL AS STRING) AS method_name FROM {pdstest} p LEFT JOIN {medium} m ON m.medium_id = p.medium_id")
def _(t):
    tests = t.pdstest.select("test_id", F.col("medium_id").alias("mediumkey"))
    tests = rel.join_optional(tests, t.medium, "mediumkey", "medium_id", ["medium_name"])
    tests = rel.join_optional(tests, t.method, "methodkey", "method_id", ["method_name"])
    return tests.select("test_id", "medium_name", "method_name")


_SUBMITTED = "SELECT o_orderkey AS entry, CASE o_orderkey % 4 WHEN 0 THEN 'S' || CAST(o_custkey AS STRING) WHEN 1 THEN 'SRS' || CAST(o_custkey AS STRING) WHEN 2 THEN 'ERR' || CAST(o_orderkey AS STRING) ELSE 'unknown' END AS samplename FROM {orders}"


@query(
    "join_natural_alias_chain",
    f"""SELECT e.entry, coalesce(a.sample_id, q.sample_id, b.sample_id) AS sample_id FROM ({_SUBMITTED}) e
LEFT JOIN {{sample}} a ON a.sample_name = e.samplename LEFT JOIN {{sequencing}} q ON q.library_name = e.samplename LEFT JOIN {{sample}} b ON b.sra_name = e.samplename""",
)
def _(t):
    lookups = [
        t.sample.select("sample_name", "sample_id"),
        t.sequencing.select("library_name", "sample_id"),
        t.sample.select("sra_name", "sample_id"),
    ]
    return rel.resolve_first(t.sql(_SUBMITTED), "samplename", lookups, "sample_id").select("entry", "sample_id")


@query(
    "join_keyed_lookup",
    "SELECT d.drug_id, coalesce(c.names, '') AS categories FROM {drug} d LEFT JOIN (SELECT drug_id, string_agg(DISTINCT phenotypic_category, ',' ORDER BY phenotypic_category) AS names FROM {clean_phenotype} WHERE phenotype = 'R' GROUP BY drug_id) c ON c.drug_id = d.drug_id",
)
def _(t):
    lists = t.clean_phenotype.where("phenotype = 'R'").groupBy("drug_id").agg(
        F.sort_array(F.collect_set("phenotypic_category")).alias("names")
    )
    empty = F.array().cast("array<string>")
    return t.drug.join(lists, "drug_id", "left").select(
        "drug_id", F.array_join(F.coalesce("names", empty), ",").alias("categories")
    )


@query(
    "argmin_rejoin",
    "SELECT l_partkey, min(l_extendedprice) AS lowest, CAST(count(*) FILTER (WHERE l_extendedprice = m.lo) AS BIGINT) AS rows_at_lowest FROM {lineitem} JOIN (SELECT l_partkey AS pk, min(l_extendedprice) AS lo FROM {lineitem} GROUP BY l_partkey) m ON m.pk = l_partkey GROUP BY l_partkey",
)
def _(t):
    best = rel.best_ranked_unbounded(t.lineitem.select("l_partkey", "l_extendedprice"), ["l_partkey"], F.col("l_extendedprice"))
    return best.groupBy("l_partkey").agg(F.min("l_extendedprice").alias("lowest"), F.count(F.lit(1)).alias("rows_at_lowest"))


# ------------------------------------------------------------------ aggregates


@query("agg_count", "SELECT drug_id, plate, mic_value, CAST(count(*) AS BIGINT) AS count FROM {mictest} GROUP BY drug_id, plate, mic_value")
def _(t):
    return t.mictest.groupBy("drug_id", "plate", "mic_value").count()


@query("agg_min_max", "SELECT sample_id, min(quality) AS min_quality, max(quality) AS max_quality FROM {genotype} GROUP BY sample_id")
def _(t):
    return t.genotype.groupBy("sample_id").agg(F.min("quality").alias("min_quality"), F.max("quality").alias("max_quality"))


@query("agg_sum", "SELECT variant_id, CAST(sum(alternative_ad) AS BIGINT) AS reads FROM {genotype} GROUP BY variant_id")
def _(t):
    return t.genotype.groupBy("variant_id").agg(F.sum("alternative_ad").alias("reads"))


@query("agg_count_distinct", "SELECT variant_id, CAST(count(DISTINCT sample_id) AS BIGINT) AS samples FROM {genotype} GROUP BY variant_id")
def _(t):
    distinct = t.genotype.select("variant_id", "sample_id").distinct()
    return distinct.groupBy("variant_id").agg(F.count(F.lit(1)).alias("samples"))


@query("agg_count_distinct_pair", "SELECT drug_id, CAST(count(*) AS BIGINT) AS categories FROM (SELECT DISTINCT drug_id, gene_db_crossref_id, variant_category FROM {variant_category}) c GROUP BY drug_id")
def _(t):
    return t.variant_category.groupBy("drug_id").agg(F.count_distinct("gene_db_crossref_id", "variant_category").alias("categories"))


@query("agg_set_concat", "SELECT sample_id, string_agg(DISTINCT fastq_prefix, ', ' ORDER BY fastq_prefix) AS prefixes FROM {sample_alias} GROUP BY sample_id")
def _(t):
    return t.sample_alias.groupBy("sample_id").agg(text.set_text(F.col("fastq_prefix"), ", ").alias("prefixes"))


@query("agg_ordered_string", "SELECT sample_id, string_agg(name, ';' ORDER BY id) AS names FROM {sample_alias} GROUP BY sample_id")
def _(t):
    return t.sample_alias.groupBy("sample_id").agg(text.ordered_text(F.col("id"), F.col("name"), ";").alias("names"))


@query("agg_first_ignorenulls", "SELECT sample_id, arg_min(country_id, id) FILTER (WHERE country_id IS NOT NULL) AS country_id FROM {sample_alias} GROUP BY sample_id")
def _(t):
    return t.sample_alias.groupBy("sample_id").agg(
        F.min(F.when(F.col("country_id").isNotNull(), F.struct("id", "country_id")))["country_id"].alias("country_id")
    )


@query("agg_collect_set_contains", "SELECT package_id, drug_id FROM {binarised} b JOIN (SELECT id, package_id FROM {mictest}) m ON m.id = b.mictest_id GROUP BY package_id, drug_id HAVING NOT bool_or(test_result IS NULL)")
def _(t):
    joined = t.binarised.join(t.mictest.select(F.col("id").alias("mictest_id"), "package_id"), "mictest_id")
    results = F.collect_set(F.coalesce("test_result", F.lit("U")))
    return joined.groupBy("package_id", "drug_id").agg(results.alias("all")).where(~F.array_contains("all", "U")).drop("all")


@query("agg_bool_or_and", "SELECT drug_id, bool_or(coalesce(test_result = 'R', false)) AS any_r, CAST(count(*) FILTER (WHERE test_result = 'S') AS BIGINT) = count(*) AS all_s FROM {binarised} GROUP BY drug_id")
def _(t):
    r, s = F.col("test_result") == "R", F.col("test_result") == "S"
    return t.binarised.groupBy("drug_id").agg(
        F.bool_or(F.coalesce(r, F.lit(False))).alias("any_r"), rel.count_true_as_all(s).alias("all_s")
    )


@query("agg_bool_and_nullskip", "SELECT variant_id, bool_and(medium_ok) AS all_ok FROM (SELECT sample_id AS variant_id, medium_id > 2 AS medium_ok FROM {pdstest}) p GROUP BY variant_id")
def _(t):
    return t.pdstest.groupBy(F.col("sample_id").alias("variant_id")).agg(F.bool_and(F.col("medium_id") > 2).alias("all_ok"))


@query("pivot_values", "SELECT drug_id, CAST(count(DISTINCT CASE WHEN phenotype = 'R' THEN sample_id END) AS BIGINT) AS R, CAST(count(DISTINCT CASE WHEN phenotype = 'S' THEN sample_id END) AS BIGINT) AS S FROM {clean_phenotype} GROUP BY drug_id")
def _(t):
    return rel.count_by_values(t.clean_phenotype, ["drug_id"], "phenotype", "sample_id", ["R", "S"])


@query("pivot_auto", "SELECT drug_id, CAST(sum(CASE WHEN phenotype = 'R' THEN 1 END) AS BIGINT) AS R, CAST(sum(CASE WHEN phenotype = 'S' THEN 1 END) AS BIGINT) AS S FROM {clean_phenotype} GROUP BY drug_id")
def _(t):
    counts = t.clean_phenotype.groupBy("drug_id", "phenotype").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("drug_id").pivot("phenotype", ["R", "S"]).agg(F.sum("n"))


@query("two_level_group", "SELECT n, CAST(count(*) AS BIGINT) AS samples FROM (SELECT sample_id, CAST(count(DISTINCT drug_id) AS BIGINT) AS n FROM {pdstest} GROUP BY sample_id) s GROUP BY n")
def _(t):
    inner = t.pdstest.groupBy("sample_id").agg(F.count_distinct("drug_id").alias("n"))
    return inner.groupBy("n").agg(F.count(F.lit(1)).alias("samples"))


@query(
    "rollup_subtotal",
    "SELECT drug_id, plate, CAST(count(*) AS BIGINT) AS n FROM {mictest} GROUP BY drug_id, plate UNION ALL SELECT drug_id, 'ALL', CAST(count(*) AS BIGINT) FROM {mictest} GROUP BY drug_id",
)
def _(t):
    fine = t.mictest.groupBy("drug_id", "plate").agg(F.count(F.lit(1)).alias("n"))
    total = fine.groupBy("drug_id").agg(F.sum("n").alias("n")).withColumn("plate", F.lit("ALL"))
    return fine.unionByName(total)


@query(
    "proportion_ci95",
    """SELECT drug_id, round(100.0 * r / n, 6) AS percentage, round(100 * (r / n - 1.96 * sqrt(r / n * (1 - r / n) / n)), 6) AS interval_lower, round(100 * (r / n + 1.96 * sqrt(r / n * (1 - r / n) / n)), 6) AS interval_upper
FROM (SELECT drug_id, CAST(count(*) FILTER (WHERE phenotype = 'R') AS DOUBLE) AS r, CAST(count(*) AS DOUBLE) AS n FROM {clean_phenotype} GROUP BY drug_id) c""",
)
def _(t):
    counts = t.clean_phenotype.groupBy("drug_id").agg(
        F.count_if(F.col("phenotype") == "R").alias("r"), F.count(F.lit(1)).alias("n")
    )
    names = ["percentage", "interval_lower", "interval_upper"]
    rows = rel.proportion_ci95(counts, F.col("r"), F.col("n"))
    return rows.select("drug_id", *[F.round(c, 6).alias(c) for c in names])


@query(
    "mode_with_tiebreak",
    "SELECT l_suppkey, l_partkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rn FROM (SELECT l_suppkey, l_partkey, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS n FROM {lineitem} GROUP BY l_suppkey, l_partkey) c) x WHERE rn = 1",
)
def _(t):
    return rel.mode_with_tiebreak(t.lineitem, ["l_suppkey"], "l_partkey", "l_orderkey")


@query("collect_map_by_group", "SELECT drug_id AS k, string_agg(phenotypic_category || '=' || CAST(n AS STRING), ',' ORDER BY phenotypic_category) AS entries FROM (SELECT drug_id, phenotypic_category, count(*) AS n FROM {clean_phenotype} GROUP BY drug_id, phenotypic_category) c GROUP BY drug_id")
def _(t):
    counts = t.clean_phenotype.groupBy("drug_id", "phenotypic_category").agg(F.count(F.lit(1)).alias("n"))
    mapped = rel.map_by_group(counts, "drug_id", "phenotypic_category", ["n"])
    entries = F.transform(F.map_entries("group_results"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["n"].cast("string")))
    return mapped.select(F.col("drug_id").alias("k"), F.array_join(entries, ",").alias("entries"))


@query("collect_nested", "SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS nations, CAST(sum(customers) AS BIGINT) AS customers FROM {region} JOIN {nation} ON n_regionkey = r_regionkey JOIN (SELECT c_nationkey, count(*) AS customers FROM {customer} GROUP BY c_nationkey) c ON c_nationkey = n_nationkey GROUP BY r_name")
def _(t):
    inner = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    nations = t.nation.join(inner, F.col("n_nationkey") == F.col("c_nationkey"))
    nested = nations.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_name", "customers"))).alias("nations"))
    total = F.aggregate("nations", F.lit(0).cast("long"), lambda a, n: a + n["customers"])
    return nested.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "r_name", F.array_join("nations.n_name", ",").alias("nations"), total.alias("customers")
    )


@query("array_agg_files", "SELECT sample_id, string_agg(DISTINCT file_path, ',' ORDER BY file_path) AS paths FROM {sequencing} GROUP BY sample_id")
def _(t):
    return t.sequencing.groupBy("sample_id").agg(F.array_join(F.sort_array(F.collect_set("file_path")), ",").alias("paths"))


# ------------------------------------------------------------------ windows, order, sets


@query("rank_by_case", "SELECT test_id, sample_id FROM (SELECT *, rank() OVER (PARTITION BY sample_id, drug_id ORDER BY CASE phenotypic_category WHEN 'WHO_current' THEN 1 WHEN 'WHO_past' THEN 2 ELSE 3 END) AS rk FROM {categorised_test}) x WHERE rk = 1")
def _(t):
    rank = text.priority(F.col("phenotypic_category"), ["WHO_current", "WHO_past"], 3)
    return rel.best_ranked_unbounded(t.categorised_test, ["sample_id", "drug_id"], rank).select("test_id", "sample_id")


@query("rank_multi_key", "SELECT variant_id, drug_id, gene_db_crossref_id FROM (SELECT *, rank() OVER (PARTITION BY variant_id, drug_id ORDER BY tier, gene_db_crossref_id) AS rk FROM {variant_category}) x WHERE rk = 1")
def _(t):
    return rel.best_ranked(t.variant_category, ["variant_id", "drug_id"], F.col("tier"), F.col("gene_db_crossref_id")).select("variant_id", "drug_id", "gene_db_crossref_id")


@query("rank_distance", "SELECT annotation_id, CAST(rank() OVER (PARTITION BY floor(annotation_id / 10) ORDER BY CASE WHEN predicted_effect LIKE 'missense%' THEN 1 WHEN predicted_effect = 'upstream_gene_variant' THEN distance_to_reference + 2 END NULLS LAST) AS INT) AS rank FROM {annotation}")
def _(t):
    from pyspark.sql import Window

    order = text.first_match(
        [
            (F.col("predicted_effect").startswith("missense"), F.lit(1)),
            (F.col("predicted_effect") == "upstream_gene_variant", F.col("distance_to_reference") + 2),
        ]
    )
    by_variant = Window.partitionBy(F.floor(F.col("annotation_id") / 10)).orderBy(order.asc_nulls_last())
    return t.annotation.select("annotation_id", F.rank().over(by_variant).alias("rank"))


@query("row_number_desc", "SELECT c_nationkey, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM {customer}) x WHERE rn = 1")
def _(t):
    return rel.top1_per_group(t.customer, ["c_nationkey"], [-F.col("c_acctbal"), F.col("c_custkey")], ["c_custkey"])


@query("row_number_nulls_last", "SELECT sample_id, test_id FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY concentration DESC NULLS LAST, test_id) AS rn FROM {pdstest}) x WHERE rn = 1")
def _(t):
    order = [F.coalesce(-F.col("concentration"), F.lit(float("inf"))), F.col("test_id")]
    return rel.top1_per_group(t.pdstest, ["sample_id"], order, ["test_id"])


@query("row_number_first_alias", "SELECT sample_id, name FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY id) AS rn FROM {sample_alias}) x WHERE rn = 1")
def _(t):
    return rel.top1_per_group(t.sample_alias, ["sample_id"], [F.col("id")], ["name"])


@query("distinct_on", "SELECT sample_id, variant_id, genotyper, quality, total_dp FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, variant_id, genotyper ORDER BY quality DESC, total_dp) AS rn FROM {genotype}) x WHERE rn = 1")
def _(t):
    rows = t.genotype.select("sample_id", "variant_id", "genotyper", "quality", "total_dp")
    return rel.distinct_on(rows, ["sample_id", "variant_id", "genotyper"], [-F.col("quality"), F.col("total_dp")])


@query("lag_lower_bound", "SELECT plate, drug_id, concentration, coalesce(lag(concentration) OVER (PARTITION BY plate, drug_id ORDER BY concentration), 0) AS lower_bound FROM {plate_concentration}")
def _(t):
    return rel.previous_value(t.plate_concentration, ["plate", "drug_id"], "concentration", "lower_bound")


@query("fill_from_group_first", "SELECT id, coalesce(a.country_id, f.country_id) AS country_id FROM {sample_alias} a LEFT JOIN (SELECT sample_id, arg_min(country_id, id) FILTER (WHERE country_id IS NOT NULL) AS country_id FROM {sample_alias} GROUP BY sample_id) f ON f.sample_id = a.sample_id")
def _(t):
    return rel.fill_from_group(t.sample_alias.select("id", "sample_id", "country_id"), ["sample_id"], "country_id", "id").select("id", "country_id")


@query("sort_keys", "SELECT variant_id, drug_id, position FROM {variant_category} ORDER BY variant_id, drug_id, position")
def _(t):
    return t.variant_category.select("variant_id", "drug_id", "position").orderBy("variant_id", "drug_id", "position")


@query("sort_by_custom_order", "SELECT test_id, CASE phenotypic_category WHEN 'WHO_current' THEN 1 WHEN 'WHO_past' THEN 2 WHEN 'WHO_undefined' THEN 3 END AS position FROM {categorised_test}")
def _(t):
    places = {"WHO_current": 1, "WHO_past": 2, "WHO_undefined": 3}
    order = F.create_map(*[F.lit(x) for pair in places.items() for x in pair])
    place = F.try_element_at(order, F.col("phenotypic_category"))
    return t.categorised_test.select("test_id", place.alias("position")).orderBy(F.col("position").asc_nulls_last(), "test_id")


@query("limit_batch", "SELECT id FROM {sample} WHERE bioanalysis_status = 'Unprocessed' ORDER BY id LIMIT 100")
def _(t):
    return t.sample.where("bioanalysis_status = 'Unprocessed'").select("id").orderBy("id").limit(100)


@query("top1_per_group", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM {lineitem}) x WHERE rn = 1")
def _(t):
    return rel.top1_per_group(t.lineitem, ["l_orderkey"], [-F.col("l_extendedprice"), F.col("l_linenumber")], ["l_linenumber"])


@query("union_by_name", "SELECT sample_id, drug_id FROM {pdstest} UNION ALL SELECT sample_id, drug_id FROM {mictest}")
def _(t):
    return t.pdstest.select("sample_id", "drug_id").unionByName(t.mictest.select("drug_id", "sample_id"))


@query("union_missing_cols", "SELECT sample_id, drug_id, plate FROM {mictest} UNION ALL SELECT sample_id, drug_id, NULL FROM {pdstest}")
def _(t):
    return t.mictest.select("sample_id", "drug_id", "plate").unionByName(t.pdstest.select("sample_id", "drug_id"), allowMissingColumns=True)


@query("union_distinct", "SELECT sample_id, drug_id FROM {pdstest} UNION SELECT sample_id, drug_id FROM {mictest}")
def _(t):
    return t.pdstest.select("sample_id", "drug_id").unionByName(t.mictest.select("sample_id", "drug_id")).distinct()


@query("intersect_rows", "SELECT sample_id, drug_id FROM {pdstest} INTERSECT SELECT sample_id, drug_id FROM {mictest}")
def _(t):
    return rel.key_exists(t.pdstest.select("sample_id", "drug_id").distinct(), t.mictest, ["sample_id", "drug_id"])


@query("except_rows", "SELECT sample_id, drug_id FROM {pdstest} EXCEPT SELECT sample_id, drug_id FROM {mictest}")
def _(t):
    return rel.key_absent(t.pdstest.select("sample_id", "drug_id").distinct(), t.mictest, ["sample_id", "drug_id"])


# ------------------------------------------------------------------ scalar functions


@query(
    "string_functions",
    r"""SELECT variant_id, gene, regexp_extract(nucleotidic, '([0-9]+)', 1) AS digits, regexp_replace(effect, '_variant$', '') AS short, upper(substr(effect, 1, 4)) || '_' || CAST(length(nucleotidic) AS STRING) AS tag, replace(effect, '_', ' ') AS words, trim('  ' || effect || ' ') AS trimmed, starts_with(effect, 'mis') AS mis FROM {effect_text}""",
)
def _(t):
    e = F.col("effect")
    return t.effect_text.select(
        "variant_id",
        "gene",
        F.regexp_extract("nucleotidic", "([0-9]+)", 1).alias("digits"),
        F.regexp_replace(e, "_variant$", "").alias("short"),
        F.concat_ws("_", F.upper(F.substring(e, 1, 4)), F.length("nucleotidic").cast("string")).alias("tag"),
        F.replace(e, F.lit("_"), F.lit(" ")).alias("words"),
        F.trim(F.concat(F.lit("  "), e, F.lit(" "))).alias("trimmed"),
        e.startswith("mis").alias("mis"),
    )


@query("split_explode", "SELECT variant_id, CAST(i - 1 AS INT) AS offset_in_text, substr(reference_nucleotide, i, 1) AS letter FROM {variant}, LATERAL (SELECT unnest(generate_series(1, length(reference_nucleotide))) AS i) s")
def _(t):
    return t.variant.select("variant_id", F.posexplode(F.split("reference_nucleotide", "")).alias("offset_in_text", "letter"))


@query(
    "date_functions",
    "SELECT o_orderkey, '[' || strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(o_orderdate, '%Y-%m-%d') || ']' AS day_range, '[' || CAST(year(o_orderdate) AS STRING) || '-01-01,' || CAST(year(o_orderdate) AS STRING) || '-12-31]' AS year_range FROM {orders}",
)
def _(t):
    from strainwise.operators.ingest import date_range

    none = F.lit(None).cast("string")
    return t.orders.select(
        "o_orderkey",
        date_range(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(None).cast("int")).alias("day_range"),
        date_range(none, F.year("o_orderdate")).alias("year_range"),
    )


@query(
    "math_functions",
    "SELECT g.sample_id, g.variant_id, g.genotyper, g.quality, g.af, CAST(floor(1 + (g.total_dp - 1) / 3) AS BIGINT) AS codon, round(sqrt(CAST(g.total_dp AS DOUBLE)), 6) AS root, CAST(floor((g.alternative_ad + g.total_dp) / 2) AS BIGINT) AS middle FROM {genotype_af} g",
)
def _(t):
    return t.genotype.select(
        "sample_id",
        "variant_id",
        "genotyper",
        "quality",
        numeric.allele_fraction().alias("af"),
        numeric.codon_of(F.col("total_dp")).alias("codon"),
        F.round(F.sqrt(F.col("total_dp").cast("double")), 6).alias("root"),
        F.expr("(alternative_ad + total_dp) div 2").alias("middle"),
    )


@query("cast_functions", "SELECT id, TRY_CAST(regexp_extract(mic_value, '[(\\[](.*),(.*)[\\])]', 2) AS DOUBLE) AS upper_value, CAST(staging AS INT) AS staging, CAST(id AS STRING) AS label FROM {mictest}")
def _(t):
    from strainwise.functions.intervals import upper_bound

    return t.mictest.select(
        "id", upper_bound(F.col("mic_value")).alias("upper_value"), F.col("staging").cast("int").alias("staging"),
        F.col("id").cast("string").alias("label"),
    )


@query("array_functions", "SELECT sample_id, CAST(count(DISTINCT name) AS INT) AS names, min(name) AS first_name, bool_or(fastq_prefix = 'fq1') AS has_fq1 FROM {sample_alias} GROUP BY sample_id")
def _(t):
    lists = t.sample_alias.groupBy("sample_id").agg(F.collect_list("name").alias("n"), F.collect_set("fastq_prefix").alias("p"))
    return lists.select(
        "sample_id",
        F.size(F.array_distinct("n")).alias("names"),
        F.sort_array("n")[0].alias("first_name"),
        F.array_contains("p", "fq1").alias("has_fq1"),
    )


@query("map_functions", "SELECT drug_id, coalesce(CAST(count(*) FILTER (WHERE plate = 'MGIT') AS BIGINT), 0) AS mgit FROM {mictest} GROUP BY drug_id")
def _(t):
    counts = t.mictest.groupBy("drug_id", "plate").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("drug_id").agg(F.map_from_entries(F.collect_list(F.struct("plate", "n"))).alias("m"))
    return maps.select("drug_id", F.coalesce(F.try_element_at("m", F.lit("MGIT")), F.lit(0)).alias("mgit"))


@query("json_functions", """SELECT drug_id, '{{"drug_id":' || CAST(drug_id AS STRING) || ',"drug_name":"' || drug_name || '"}}' AS body FROM {drug}""")
def _(t):
    return t.drug.select("drug_id", F.to_json(F.struct("drug_id", "drug_name")).alias("body"))


@query("hash_functions", "SELECT doc_id, md5(text) AS digest FROM {documents}")
def _(t):
    return t.documents.select("doc_id", F.md5("text").alias("digest"))


# ------------------------------------------------------------------ incremental, ML


@query("incremental_load", "SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS price FROM {orders}")
def _(t):
    """Stream the orders file to a table; the second run finds nothing new."""
    root = work_area(t.spark, "stream")
    options = {"pathGlobFilter": "orders.parquet"}
    for _run in range(2):
        stream = incremental.stream_files(t.spark, t.folder, t.orders.schema, "parquet", options)
        incremental.incremental_load(
            stream,
            lambda b: b.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price")),
            f"{root}/table",
            f"{root}/checkpoint",
        )
    return incremental.loaded(t.spark, f"{root}/table")


@query("incremental_dedup", "SELECT DISTINCT user_id, event_type FROM {events}")
def _(t):
    root = work_area(t.spark, "unseen")
    stream = incremental.stream_files(t.spark, t.folder, t.events.schema, "parquet", {"pathGlobFilter": "events.parquet"})
    incremental.load_unseen(
        stream, lambda b: b.select("user_id", "event_type"), ["user_id", "event_type"], f"{root}/table", f"{root}/checkpoint"
    )
    return incremental.loaded(t.spark, f"{root}/table")


@query("row_map", "SELECT sample_id, CASE WHEN taxon = 7 THEN 8 ELSE taxon END AS taxon FROM (SELECT sample_id, CAST(drug_id AS INT) AS taxon FROM {pdstest}) p WHERE taxon <> 1")
def _(t):
    taxon = F.when(F.col("drug_id") == 7, 8).otherwise(F.col("drug_id"))
    return t.pdstest.select("sample_id", taxon.alias("taxon")).where("taxon <> 1")


# One factor times 1 to 8: the only component is the centred factor times the length of (1, ..., 8), turned so that its largest score is positive.

@query(
    "center_pca_one_factor",
    "SELECT vec_id, round((x - m) * sqrt(204) * s, 5) AS pc1 FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x FROM {embeddings}) e, (SELECT m, arg_max(sign(x - m), abs(x - m)) AS s FROM (SELECT CAST(embedding[1] AS DOUBLE) AS x FROM {embeddings}) a, (SELECT avg(CAST(embedding[1] AS DOUBLE)) AS m FROM {embeddings}) b GROUP BY m) c",
)
def _(t):
    multiples = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda j: j * F.col("embedding")[0].cast("double"))
    rows = t.embeddings.select("vec_id", multiples.alias("v"))
    return matrix.center_pca(rows, "vec_id", "v", k=1).select("vec_id", F.round("pc1", 5).alias("pc1"))


# Six columns made of three: all of a row's centred length, and its product with the first row, lie in three components, which do not correlate.

_SIX = "SELECT vec_id, [x, y, z, x + y, y - z, x + y + z] AS v FROM (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM {embeddings}) e"
_CENTRED = f"SELECT vec_id, {', '.join(f'v[{i}] - avg(v[{i}]) OVER () AS c{i}' for i in range(1, 7))} FROM ({_SIX}) s"


@query(
    "center_pca_three_factors",
    f"SELECT a.vec_id, round({' + '.join(f'a.c{i} * a.c{i}' for i in range(1, 7))}, 5) AS squared, round({' + '.join(f'a.c{i} * b.c{i}' for i in range(1, 7))}, 5) AS with_first, 0.0 AS correlated, true AS falling FROM ({_CENTRED}) a, (SELECT * FROM ({_CENTRED}) c ORDER BY vec_id LIMIT 1) b",
)
def _(t):
    x, y, z = (F.col("embedding")[i].cast("double") for i in range(3))
    found = matrix.center_pca(t.embeddings.select("vec_id", F.array(x, y, z, x + y, y - z, x + y + z).alias("v")), "vec_id", "v", k=4)
    names = ["pc1", "pc2", "pc3", "pc4"]
    first = F.min_by(F.struct(*names), "vec_id").alias("first")
    over_all = found.agg(
        first, *[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for i, a in enumerate(names) for b in names[i:]]
    ).first()
    apart = max(abs(over_all[f"{a}{b}"]) for i, a in enumerate(names) for b in names[i + 1:])
    lengths = [over_all[f"{a}{a}"] for a in names]
    squared, with_first = (sum((F.col(n) * other(n) for n in names), F.lit(0.0)) for other in (F.col, lambda n: F.lit(over_all["first"][n])))
    return found.select(
        "vec_id", F.round(squared, 5).alias("squared"), F.round(with_first, 5).alias("with_first"),
        F.round(F.lit(float(apart)), 4).alias("correlated"), F.lit(lengths == sorted(lengths, reverse=True)).alias("falling"),
    )


@query("ml_center_pca")
def _(t):
    return matrix.center_pca(t.embeddings, "vec_id", "embedding", k=10)


@query("udf_vector_to_list", "SELECT vec_id, CAST(len(embedding) AS INT) AS width, CAST(embedding[1] AS DOUBLE) AS first_value FROM {embeddings}")
def _(t):
    from pyspark.ml.functions import array_to_vector, vector_to_array

    values = vector_to_array(array_to_vector(F.col("embedding").cast("array<double>")))
    return t.embeddings.select("vec_id", F.size(values).alias("width"), values[0].alias("first_value"))


@query("split_choices", "SELECT id, TRY_CAST(plate AS INT) AS plate_int, plate AS plate_string FROM {mictest}")
def _(t):
    return sinks.split_choices(t.mictest, "plate", {"int": "int", "string": "string"}).select("id", "plate_int", "plate_string")
