"""Documents for a gene browser: results per gene and variant, nested and as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, FloatType, StringType, StructType

from strainwise.functions.hgvs import after_last_colon
from strainwise.operators.relational import map_by_group
from strainwise.sources.sinks import json_number

VARIANT_FIELDS = ["variant_id", "pos", "consequence", "hgvsc", "hgvsp", "info", "group_results"]
DATASET = "tb"


def variant_results(results: DataFrame, annotations: DataFrame) -> DataFrame:
    """Annotated variants, every one of them, with place, alleles and a map of results per analysis group.

    A position may lie beyond the reference; one that is no number raises, a missing one is NULL.
    """
    fields = [name for name in results.columns if name not in ("ID", "analysis_group")]
    grouped = map_by_group(results, "ID", "analysis_group", fields)
    part = F.split("variant_key", ":")
    return (
        annotations.select(
            "ID",
            "gene_id",
            F.col("Consequence").alias("consequence"),
            F.col("`Variant ID`").alias("variant_key"),
            after_last_colon(F.col("HGVSc")).alias("hgvsc"),
            after_last_colon(F.col("HGVSp")).alias("hgvsp"),
        )
        .join(grouped, "ID", "left")
        .select(
            F.struct(part[0].alias("contig"), part[1].cast("int").alias("position")).alias("locus"),
            F.array(part[2], part[3]).alias("alleles"),
            "gene_id",
            "consequence",
            "hgvsc",
            "hgvsp",
            F.struct(F.lit(1).alias("in_analysis"), F.lit("").alias("comment"), F.lit(0).alias("cadd")).alias("info"),
            "group_results",
        )
    )


def gene_results(results: DataFrame) -> DataFrame:
    """Map of results per analysis group for every gene."""
    fields = [name for name in results.columns if name not in ("gene_id", "analysis_group")]
    return map_by_group(results, "gene_id", "analysis_group", fields)


def distinct_groups(df: DataFrame, map_column: str = "group_results") -> DataFrame:
    """One row with the sorted set of all map keys; keys are de-duplicated before they meet."""
    keys = df.select(F.explode(F.map_keys(map_column)).alias("group")).distinct()
    return keys.agg(F.sort_array(F.collect_set("group")).alias("groups"))


def _by_group_order(df: DataFrame) -> DataFrame:
    """``group_results`` as an array in the order of all groups; absent groups are NULL."""
    ordered = F.transform("_groups", lambda g: F.try_element_at("group_results", g))
    with_groups = df.withColumn("_groups", distinct_groups(df).scalar())
    return with_groups.withColumn("group_results", ordered).drop("_groups")


def _type_name(kind: DataType) -> str:
    return {"float": "float", "double": "float", "int": "int", "bigint": "int", "string": "str", "boolean": "bool"}[
        kind.simpleString()
    ]


def combine_browser(
    genes: DataFrame, by_gene: DataFrame, by_variant: DataFrame, per_document: int = 50000
) -> tuple[DataFrame, DataFrame]:
    """Genes with their results, and the variants of each gene in documents of bounded size.

    A gene with at most ``per_document`` variants has one document (part 0 of 1).  A
    gene with more is spread over several by the hash of the variant, so that no task
    has to hold all variants of a gene.
    """
    results = _by_group_order(by_gene).select("gene_id", F.col("group_results").alias("gene_results"))
    place, allele = F.col("locus"), F.col("alleles")
    name = F.concat_ws(
        "-", F.regexp_replace(place["contig"], "^chr", ""), place["position"].cast("string"), allele[0], allele[1]
    )
    flat = _by_group_order(by_variant).select(
        "gene_id",
        name.alias("variant_id"),
        place["position"].alias("pos"),
        "consequence",
        "hgvsc",
        "hgvsp",
        "info",
        "group_results",
    )
    sizes = by_variant.groupBy("gene_id").agg(F.ceil(F.count(F.lit(1)) / per_document).cast("int").alias("parts"))
    variants = (
        flat.join(sizes, "gene_id")
        .withColumn("part", F.pmod(F.xxhash64("variant_id"), F.col("parts")).cast("int"))
        .groupBy("gene_id", "part", "parts")
        .agg(F.sort_array(F.collect_list(F.struct("pos", F.struct(*VARIANT_FIELDS).alias("v")))).alias("_rows"))
        .select("gene_id", "part", "parts", F.transform("_rows", lambda r: r["v"]).alias("variants"))
    )
    return genes.join(results, "gene_id", "left"), variants


def browser_metadata(by_gene: DataFrame, by_variant: DataFrame, reference: str = "h37Rv") -> DataFrame:
    """Names, types and group order of the result tuples, one row."""

    def shape(df: DataFrame, column: str) -> StructType:
        kind = df.schema[column].dataType
        return kind if isinstance(kind, StructType) else kind.valueType

    def texts(values: list[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    gene_shape, variant_shape, info = (
        shape(by_gene, "group_results"), shape(by_variant, "group_results"), shape(by_variant, "info"),
    )
    described = {
        "reference_genome": F.lit(reference),
        "gene_group_result_field_names": texts(gene_shape.names),
        "gene_group_result_field_types": texts([_type_name(f.dataType) for f in gene_shape.fields]),
        "variant_info_field_names": texts(info.names),
        "variant_info_field_types": texts([_type_name(f.dataType) for f in info.fields]),
        "variant_group_result_field_names": texts(variant_shape.names),
        "variant_group_result_field_types": texts([_type_name(f.dataType) for f in variant_shape.fields]),
        "variant_result_analysis_groups": distinct_groups(by_variant).scalar(),
    }
    groups = distinct_groups(by_gene).withColumnRenamed("groups", "gene_result_analysis_groups")
    return groups.select("*", *[column.alias(name) for name, column in described.items()])


# ------------------------------------------------------------------ JSON text
def json_text(value: Column, kind: DataType, tuples: bool = True) -> Column:
    """JSON of a column; structs become arrays of their fields with ``tuples``, else objects."""
    if isinstance(kind, (FloatType, DoubleType)):
        return json_number(value.cast("double"))
    if isinstance(kind, StringType):
        return F.regexp_replace(F.to_json(F.array(value)), r"^\[|\]$", "")
    if isinstance(kind, ArrayType):
        items = F.transform(value, lambda item: json_text(item, kind.elementType, tuples))
        return F.coalesce(F.concat(F.lit("["), F.array_join(items, ","), F.lit("]")), F.lit("null"))
    if isinstance(kind, StructType):
        fields = [json_text(value[f.name], f.dataType, tuples) for f in kind.fields]
        if tuples:
            body = F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]"))
        else:
            named = [F.concat(F.lit(f'"{f.name}":'), text) for f, text in zip(kind.fields, fields)]
            body = F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))
        return F.when(value.isNull(), F.lit("null")).otherwise(body)
    if isinstance(kind, BooleanType):
        return F.coalesce(value.cast("string"), F.lit("null"))
    return F.coalesce(value.cast("string"), F.lit("null"))


def _document(folder: Column, name: Column, body: Column) -> Column:
    return F.struct(folder.alias("folder"), name.alias("name"), body.alias("body"))


def browser_documents(genes: DataFrame, variants: DataFrame) -> DataFrame:
    """(folder, name, body) of all documents: search terms, gene results, genes and their variants."""

    def folder(gene: Column) -> Column:
        return F.concat(F.lit("genes/"), F.lpad((gene.try_cast("long") % 1000).cast("string"), 3, "0"))

    schema = genes.schema
    gene = F.col("gene_id")
    quoted = json_text(gene, StringType())
    terms = F.concat(
        F.lit("["), quoted, F.lit(","), json_text(F.col("search_terms"), schema["search_terms"].dataType), F.lit("]")
    )
    middle = F.floor((F.col("start") + F.col("stop")) / 2).cast("string")
    result = F.concat(
        F.lit("["),
        F.concat_ws(
            ",", quoted, quoted, quoted, json_text(F.col("chrom"), StringType()), middle,
            json_text(F.col("gene_results"), schema["gene_results"].dataType),
        ),
        F.lit("]"),
    )
    model_fields = [f for f in schema.fields if f.name not in ("search_terms", "gene_results")]
    model = F.concat_ws(
        ",", *[F.concat(F.lit(f'"{f.name}":'), json_text(F.col(f.name), f.dataType, False)) for f in model_fields]
    )
    gene_body = F.concat(F.lit('{"gene":{"reference_genome":"h37Rv",'), model, F.lit("}}"))
    one = F.concat(F.col("gene_id"), F.lit(f"_{DATASET}_variants.json"))
    several = F.concat(F.col("gene_id"), F.lit(f"_{DATASET}_variants_"), F.col("part").cast("string"), F.lit(".json"))
    variants_body = F.concat(
        F.lit('{"variants":'), json_text(F.col("variants"), variants.schema["variants"].dataType), F.lit("}")
    )
    # The three documents of a gene come from one reading of its row.
    made = F.array(
        _document(F.lit("search"), F.concat(gene, F.lit(".json")), terms),
        F.when(F.col("gene_results").isNotNull(), _document(F.lit("results"), F.concat(gene, F.lit(f"_{DATASET}.json")), result)),
        _document(folder(gene), F.concat(gene, F.lit("_h37Rv.json")), gene_body),
    )
    name = F.when(F.col("parts") == 1, one).otherwise(several)
    return genes.select(F.inline(F.array_compact(made))).unionByName(
        variants.select(folder(gene).alias("folder"), name.alias("name"), variants_body.alias("body"))
    )
