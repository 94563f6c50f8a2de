"""Raw files to tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainwise import rules, schemas
from strainwise.functions.intervals import canonical_interval
from strainwise.operators.relational import (
    apply_mapping,
    drop_null_fields,
    join_optional,
    previous_value,
    resolve_first,
    select_fields,
    top1_per_group,
)
from strainwise.sources.sinks import align_to_schema, upsert_coalesce

ALLELE = ["chromosome", "position", "reference_nucleotide", "alternative_nucleotide"]
STAGED_COLUMNS = schemas.column_names(schemas.STAGED_GENOTYPE)


def gated(raw: DataFrame, sample: DataFrame, key: str = "sampleid", status: str = rules.READY_STATUS) -> DataFrame:
    """Rows of samples whose processing has reached ``status``."""
    ready = sample.where(F.col("bioanalysis_status") == status).select(F.col("id").alias(key))
    return raw.join(ready, key, "left_semi")


# ------------------------------------------------------------------ genotypes
_GENOTYPE_MAPPING = [
    ("genotyper", "genotyper", "string"),
    ("sampleid", "sample_id", "int"),
    ("chrom", "chromosome", "string"),
    ("pos", "position", "int"),
    ("altad", "alternative_ad", "int"),
    ("ref", "reference_nucleotide", "string"),
    ("alt", "alternative_nucleotide", "string"),
    ("qual", "quality", "double"),
    ("refad", "reference_ad", "int"),
    ("id", "variant_id", "int"),
    ("totaldp", "total_dp", "int"),
    ("value", "genotype_value", "string"),
]


def load_known_genotypes(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Calls whose variant id is known."""
    mapped = apply_mapping(gated(raw, sample), _GENOTYPE_MAPPING).where(F.col("variant_id").isNotNull())
    return align_to_schema(mapped, schemas.struct_type(schemas.GENOTYPE))


def stage_new_genotypes(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Calls of variants that have no id yet."""
    mapped = apply_mapping(gated(raw, sample), _GENOTYPE_MAPPING).where(F.col("variant_id").isNull())
    return mapped.select(*STAGED_COLUMNS)


def register_new_variants(staged: DataFrame) -> DataFrame:
    """Distinct alleles of staged calls."""
    return staged.select(*ALLELE).distinct()


def resolve_staged_genotypes(staged: DataFrame, variant: DataFrame) -> DataFrame:
    """Staged calls with the id their alleles have been given."""
    joined = staged.join(variant.select("variant_id", *ALLELE), ALLELE)
    return select_fields(joined, schemas.column_names(schemas.GENOTYPE))


# ------------------------------------------------------------------ deletions
def load_deletions(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Deletion calls with read counts from paired and split reads."""
    counted = gated(raw, sample).select(
        "*", (F.col("rr") + F.col("dr")).alias("reference_ad"), (F.col("rv") + F.col("dv")).alias("alternative_ad")
    )
    return apply_mapping(
        counted.withColumn("total_dp", F.col("reference_ad") + F.col("alternative_ad")),
        [
            ("sampleid", "sample_id", "int"),
            ("chromosome", "chromosome", "string"),
            ("position", "position", "int"),
            ("deletion", "reference_nucleotide", "string"),
            ("alternativenucleotide", "alternative_nucleotide", "string"),
            ("total_dp", "total_dp", "int"),
            ("quality", "quality", "double"),
            ("alternative_ad", "alternative_ad", "int"),
            ("reference_ad", "reference_ad", "int"),
            ("genotyper", "genotyper", "string"),
            ("value", "genotype_value", "string"),
        ],
    )


def with_deletion_length(staged: DataFrame) -> DataFrame:
    """Staged deletions (``DEL-<end>``) with their length."""
    end = F.regexp_extract("reference_nucleotide", "^DEL-([0-9]+)$", 1).try_cast("long")
    return staged.withColumn("deletion_length", end - F.col("position")).where(end.isNotNull())


def sequence_chunks(sequence: DataFrame, size: int = 8192) -> DataFrame:
    """Genome text (chromosome, seq) cut into numbered chunks, so that no task carries a whole genome per row.

    The text is gone through once: a substring would count from its start for every chunk.
    """
    pieces = F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return sequence.select("chromosome", F.posexplode(pieces).alias("chunk", "text"))


def register_deletions(
    staged: DataFrame, variant: DataFrame, chunks: DataFrame, size: int = 8192, longest: int = rules.LONGEST_DELETION
) -> DataFrame:
    """Deletions that are not in the variant table, with the deleted bases cut from the genome.

    Each deletion is matched with the genome chunks it touches and its pieces are put
    together again in order.
    """
    key = ["chromosome", "position", "alternative_nucleotide", "deletion_length"]
    known = variant.select(
        "chromosome",
        "position",
        "alternative_nucleotide",
        F.length("reference_nucleotide").cast("long").alias("deletion_length"),
    )
    fresh = (
        with_deletion_length(staged)
        .where(F.col("deletion_length").between(1, longest - 1))
        .select(*key)
        .distinct()
        .join(known, key, "left_anti")
    )
    first, last = F.col("position") - 1, F.col("position") + F.col("deletion_length") - 2
    touched = F.sequence(F.floor(first / size).cast("int"), F.floor(last / size).cast("int"))
    start = F.col("chunk").cast("long") * size
    begin = F.greatest(first - start, F.lit(0)) + 1
    until = F.least(last - start, F.lit(size - 1)) + 1
    piece = F.substring(F.col("text"), begin.cast("int"), (until - begin + 1).cast("int"))
    return (
        fresh.withColumn("chunk", F.explode(touched))
        .join(chunks, ["chromosome", "chunk"])
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list(F.struct("chunk", piece.alias("piece")))).alias("_pieces"))
        .select(
            "chromosome",
            "position",
            F.concat_ws("", F.transform("_pieces", lambda p: p["piece"])).alias("reference_nucleotide"),
            "alternative_nucleotide",
        )
        .distinct()
    )


def resolve_deletion_genotypes(staged: DataFrame, variant: DataFrame) -> DataFrame:
    """Staged deletions with the id of the variant of equal place and length; best quality per call."""
    key = ["chromosome", "position", "alternative_nucleotide", "deletion_length"]
    known = variant.select(
        "variant_id",
        "chromosome",
        "position",
        "alternative_nucleotide",
        F.length("reference_nucleotide").cast("long").alias("deletion_length"),
    )
    columns = ["quality", "reference_ad", "alternative_ad", "total_dp", "genotype_value"]
    return top1_per_group(
        with_deletion_length(staged).join(known, key),
        ["sample_id", "variant_id", "genotyper"],
        [F.coalesce(-F.col("quality"), F.lit(float("inf"))), F.col("total_dp"), F.col("alternative_ad")],
        columns,
    )


def split_multiallelic_calls(calls: DataFrame, variant: DataFrame) -> DataFrame:
    """One row per alternative allele, with the known id of its alleles.

    ``alternative_nucleotide`` and ``alternative_ad`` are comma lists in step; ``.``
    is missing.
    """
    alleles = F.arrays_zip(
        F.split("alternative_nucleotide", ",").alias("allele"), F.split("alternative_ad", ",").alias("reads")
    )
    rows = (
        calls.withColumn("_allele", F.explode(alleles))
        .withColumns(
            {
                "alternative_nucleotide": F.col("_allele.allele"),
                "alternative_ad": F.col("_allele.reads").try_cast("int"),
            }
        )
        .drop("_allele")
    )
    return rows.join(variant.select("variant_id", *ALLELE), ALLELE, "left")


def passing_deletions(calls: DataFrame) -> DataFrame:
    """Deletion calls that passed all filters and are present in the sample."""
    return calls.where((F.col("filter") == "PASS") & (F.col("alt") == "<DEL>") & (F.col("gt") != "0/0"))


# ------------------------------------------------------------------ statistics
def load_locus_stats(raw: DataFrame, sample: DataFrame, locus_tag: DataFrame) -> DataFrame:
    named = gated(raw, sample).join(
        locus_tag.select(F.col("locus_tag_name").alias("locustagname"), "gene_db_crossref_id"), "locustagname"
    )
    return apply_mapping(
        named,
        [
            ("sampleid", "sample_id", "int"),
            ("gene_db_crossref_id", "gene_db_crossref_id", "int"),
            ("meandepth", "mean_depth", "double"),
            ("cov10x", "coverage_10x", "double"),
            ("cov15x", "coverage_15x", "double"),
            ("cov20x", "coverage_20x", "double"),
            ("cov30x", "coverage_30x", "double"),
        ],
    )


def load_global_stats(raw: DataFrame, sample: DataFrame) -> DataFrame:
    mapping = [m for m in schemas.GLOBAL_STATS_MAPPING if m[0] in raw.columns]
    return apply_mapping(gated(raw, sample), mapping)


def load_taxonomy(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Taxon shares; merged taxa are remapped, unclassified reads dropped."""
    taxon = F.col("ncbi_taxon_id")
    for old, new in rules.TAXON_REMAP.items():
        taxon = F.when(taxon == old, F.lit(new)).otherwise(taxon)
    return (
        apply_mapping(
            gated(raw, sample),
            [("sampleid", "sample_id", "int"), ("ncbitaxonid", "ncbi_taxon_id", "int"), ("value", "value", "double")],
        )
        .withColumn("ncbi_taxon_id", taxon)
        .where(F.col("ncbi_taxon_id") != 0)
    )


# ------------------------------------------------------------------ laboratory tests
def _with_sample_and_drug(
    raw: DataFrame, sample: DataFrame, sequencing: DataFrame, drug: DataFrame, synonym: DataFrame
) -> DataFrame:
    """Resolve a sample by own name, run name or archive name, and a drug by name or three-letter code."""
    code = synonym.where(F.col("code") == "three_letter_code").select("drug_name_synonym", "drug_id")
    named = resolve_first(
        raw,
        "samplename",
        [
            sample.select("sample_name", "sample_id"),
            sequencing.select("library_name", "sample_id"),
            sample.select("sra_name", "sample_id"),
        ],
        "sample_id",
    )
    return resolve_first(named, "drug", [drug.select("drug_name", "drug_id"), code], "drug_id")


def load_mic(
    raw: DataFrame,
    sample: DataFrame,
    sequencing: DataFrame,
    drug: DataFrame,
    synonym: DataFrame,
    plate_concentration: DataFrame,
) -> DataFrame:
    """MIC entries as intervals; a plain value on a known plate starts at the next lower tested concentration."""
    steps = previous_value(plate_concentration, ["plate", "drug_id"], "concentration", "_lower").select(
        F.col("plate").alias("platename"), "drug_id", F.col("concentration").alias("_value"), "_lower"
    )
    return (
        _with_sample_and_drug(raw, sample, sequencing, drug, synonym)
        .withColumn("_value", F.col("value").try_cast("double"))
        .join(steps, ["platename", "drug_id", "_value"], "left")
        .select(
            F.col("sample_id").try_cast("int").alias("sample_id"),
            F.col("drug_id").try_cast("int").alias("drug_id"),
            F.col("platename").alias("plate"),
            canonical_interval(F.col("value"), F.col("_lower")).alias("mic_value"),
        )
        .dropna(subset=["sample_id", "drug_id", "mic_value"])
    )


def load_pdst(
    raw: DataFrame,
    sample: DataFrame,
    sequencing: DataFrame,
    drug: DataFrame,
    synonym: DataFrame,
    medium: DataFrame,
    method: DataFrame,
) -> DataFrame:
    """Drug-susceptibility results; medium and method are resolved where the file has them."""
    named = _with_sample_and_drug(raw, sample, sequencing, drug, synonym)
    named = join_optional(named, medium, "mediumname", "medium_name", ["medium_id"])
    named = join_optional(named, method, "methodname", "method_name", ["method_id"])
    return apply_mapping(
        named,
        [
            ("sample_id", "sample_id", "int"),
            ("drug_id", "drug_id", "int"),
            ("medium_id", "medium_id", "int"),
            ("method_id", "method_id", "int"),
            ("concentration", "concentration", "double"),
            ("result", "test_result", "string"),
        ],
    ).where("sample_id is not null and drug_id is not null and test_result <> ''")


def load_molecular_tests(raw: DataFrame, sample: DataFrame, drug: DataFrame) -> DataFrame:
    joined = raw.join(sample.select(F.col("id").alias("sampleid")), "sampleid", "left_semi").join(
        drug.select(F.col("drug_name").alias("drug"), "drug_id"), "drug"
    )
    return apply_mapping(
        joined,
        [
            ("sampleid", "sample_id", "int"),
            ("drug_id", "drug_id", "int"),
            ("moleculartestname", "test_name", "string"),
            ("result", "test_result", "string"),
        ],
    )


# ------------------------------------------------------------------ samples and data sets
def load_sequencing_data(raw: DataFrame, sample: DataFrame) -> DataFrame:
    """Sequencing files of known samples, tagged with where they are kept."""
    prefix, archive = rules.EXTERNAL_ARCHIVE
    location = F.when(F.col("filepath").startswith(prefix), F.lit(archive)).otherwise(F.lit("S3"))
    tagged = raw.join(sample.select(F.col("id").alias("sampleid")), "sampleid", "left_semi").select(
        "*", location.alias("datalocation"), F.lit("PAIRED").alias("library_layout")
    )
    return apply_mapping(
        tagged,
        [
            ("sampleid", "sample_id", "int"),
            ("datalocation", "data_location", "string"),
            ("libraryid", "library_name", "string"),
            ("filepath", "file_path", "string"),
            ("librarypreparationstrategy", "library_preparation_strategy", "string"),
            ("sequencingplatform", "sequencing_platform", "string"),
            ("library_layout", "library_layout", "string"),
            ("assay", "assay", "string"),
        ],
    )


def load_datasets(raw: DataFrame) -> DataFrame:
    mapped = apply_mapping(
        raw,
        [
            ("datasetname", "dataset_name", "string"),
            ("datasetorigin", "dataset_origin", "string"),
            ("datasetowner", "dataset_owner", "string"),
            ("contactemail", "contact_email", "string"),
            ("datasettitle", "dataset_title", "string"),
            ("description", "description", "string"),
            ("submissiondate", "submission_date", "date"),
        ],
    )
    return drop_null_fields(mapped)


def load_dataset_samples(raw: DataFrame, sample: DataFrame, dataset: DataFrame) -> DataFrame:
    return (
        raw.join(sample.select(F.col("id").alias("sampleid")), "sampleid", "left_semi")
        .join(dataset.select(F.col("dataset_name").alias("datasetname"), "dataset_id"), "datasetname")
        .select(F.col("sampleid").cast("int").alias("sample_id"), F.col("dataset_id").cast("int").alias("dataset_id"))
    )


def load_sample_aliases(raw: DataFrame, sample: DataFrame) -> DataFrame:
    known = raw.join(sample.select(F.col("id").alias("sampleid")), "sampleid", "left_semi")
    return apply_mapping(
        known,
        [
            ("sampleid", "sample_id", "int"),
            ("additionalname", "sample_name_synonym", "string"),
            ("db", "db", "string"),
            ("dblabel", "db_label", "string"),
        ],
    )


SAMPLE_MAPPING = [
    ("samplename", "sample_name", "string"),
    ("ncbitaxonid", "ncbi_taxon_id", "int"),
    ("submissiondate", "submission_date", "string"),
    ("samplingdate", "sampling_date", "string"),
    ("additionalgeographicalinformation", "additional_geographical_information", "string"),
    ("latitude", "latitude", "string"),
    ("longitude", "longitude", "string"),
    ("isolationsource", "isolation_source", "string"),
    ("country", "country_id", "int"),
    ("libraryname", "library_name", "string"),
    ("fastqprefix", "prefix", "string"),
    ("librarypreparationstrategy", "library_preparation_strategy", "string"),
    ("sequencingplatform", "sequencing_platform", "string"),
    ("librarylayout", "library_layout", "string"),
    ("countrycode", "country_code", "string"),
    ("collectionyear", "collection_year", "int"),
    ("bucketname", "bucket_name", "string"),
    ("awsbucketregion", "aws_bucket_region", "string"),
]


def load_samples(raw: DataFrame) -> DataFrame:
    """Submitted sample sheet under table names; columns a sheet lacks are left out."""
    return apply_mapping(raw, [m for m in SAMPLE_MAPPING if m[0] in raw.columns])


def date_range(date: Column, year: Column) -> Column:
    """``[d,d]`` for a day, ``[y-01-01,y-12-31]`` for a year, else NULL."""
    text = year.cast("string")
    return F.when(date.isNotNull(), F.concat(F.lit("["), date, F.lit(","), date, F.lit("]"))).when(
        year.isNotNull(), F.concat(F.lit("["), text, F.lit("-01-01,"), text, F.lit("-12-31]"))
    )


UPSERTED = [
    "country_id",
    "ncbi_taxon_id",
    "sampling_date",
    "submission_date",
    "additional_geographical_information",
    "latitude",
    "longitude",
    "isolation_source",
]


def upsert_samples(entries: DataFrame, current: DataFrame, sequencing: DataFrame, country: DataFrame) -> DataFrame:
    """Sample table after a submission.

    A submitted run or archive name stands for the sample that has it; names that stay
    archive names are refused; known samples keep old values where the entry has none.
    """
    runs = sequencing.select("sample_id", "library_name").distinct().join(
        current.select("sample_id", "sample_name"), "sample_id"
    )
    resolved = resolve_first(
        entries.withColumnRenamed("sample_name", "_submitted"),
        "_submitted",
        [runs.select("library_name", "sample_name"), current.select("sra_name", "sample_name")],
        "_known",
    )
    codes = country.select(F.col("three_letters_code").alias("country_code"), F.col("country_id").alias("_country"))
    incoming = resolved.join(codes, "country_code", "left").select(
        F.coalesce("_known", "_submitted").alias("sample_name"),
        F.coalesce("_country", "country_id").alias("country_id"),
        F.coalesce("ncbi_taxon_id", F.lit(rules.DEFAULT_TAXON)).alias("ncbi_taxon_id"),
        date_range(F.col("sampling_date"), F.col("collection_year")).alias("sampling_date"),
        F.col("submission_date").try_cast("date").alias("submission_date"),
        "additional_geographical_information",
        "latitude",
        "longitude",
        "isolation_source",
    )
    accepted = incoming.where(~F.col("sample_name").rlike(rules.REFUSED_SAMPLE_NAME))
    # A known sample keeps its taxon: the conflict rule does not touch that column.
    stable = accepted.join(current.select("sample_name", F.col("ncbi_taxon_id").alias("_taxon")), "sample_name", "left")
    accepted = stable.withColumn("ncbi_taxon_id", F.coalesce("_taxon", "ncbi_taxon_id")).drop("_taxon")
    return upsert_coalesce(current, accepted, ["sample_name"], UPSERTED)


def sequencing_defaults(entries: DataFrame) -> DataFrame:
    """Sequencing entries of a submission with defaults filled in."""
    filled = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in rules.SEQUENCING_DEFAULTS.items()}
    return (
        entries.where(F.col("bucket_name").isNotNull())
        .withColumns({"prefix": F.coalesce("prefix", "sample_name"), **filled})
        .select("sample_name", "bucket_name", "prefix", *rules.SEQUENCING_DEFAULTS)
    )
