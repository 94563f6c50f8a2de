"""Sample-by-site matrices and their principal components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strainwise import rules
from strainwise.functions.numeric import ratio
from strainwise.functions.text import first_match
from strainwise.operators.relational import PAIR_SLOTS, count_by_values, exclude_intervals, pair_all, top1_per_group
from strainwise.operators.subspace import subspace_pca
from strainwise.session import cut_lineage

#: Positions that are written out at a time.
PLACES = 1024


def allele_code(column: Column) -> Column:
    return first_match([(column == base, F.lit(code)) for base, code in rules.NUCLEOTIDE_CODES])


def repeat_intervals(
    feature: DataFrame, xref_link: DataFrame, qualifier: DataFrame, term: DataFrame, location: DataFrame
) -> DataFrame:
    """Extents of repetitive features: PE/PPE genes, transposases, PE-PGRS products."""
    named = term.where(F.col("name").isin("product", "gene")).select("term_id")
    kinds = term.select(F.col("term_id").alias("type_term_id"), F.col("name").alias("feature_type"))
    value = F.col("value")
    repeats = value.rlike(rules.REPEAT_GENE) & (F.col("feature_type") == "gene")
    for word in rules.REPEAT_PRODUCTS:
        repeats = F.coalesce(repeats, F.lit(False)) | value.contains(word)
    return (
        qualifier.join(named, "term_id", "left_semi")
        .join(feature.select("seqfeature_id", "type_term_id"), "seqfeature_id")
        .join(kinds, "type_term_id", "left")
        .where(repeats)
        .join(xref_link.select("seqfeature_id"), "seqfeature_id", "left_semi")
        .join(location.select("seqfeature_id", "start_pos", "end_pos"), "seqfeature_id")
        .select("start_pos", "end_pos")
        .distinct()
    )


def snv_sites(variant: DataFrame, repeats: DataFrame, pad: int = rules.REPEAT_PADDING) -> DataFrame:
    """Single-nucleotide variants outside repetitive regions."""
    bases = [base for base, _ in rules.NUCLEOTIDE_CODES]
    single = variant.where(
        F.col("reference_nucleotide").isin(bases) & F.col("alternative_nucleotide").isin(bases)
    ).select("variant_id", "position", "reference_nucleotide", "alternative_nucleotide")
    return exclude_intervals(single, repeats, pad).distinct()


def clear_calls(genotype: DataFrame, samples: DataFrame, min_af: float = rules.CLEAR_FRACTION) -> DataFrame:
    """Calls of the cohort in which the alternative base clearly dominates."""
    return (
        genotype.where(F.col("genotyper") == "bcftools")
        .select("sample_id", "variant_id", ratio(F.col("alternative_ad"), F.col("total_dp")).alias("dp"))
        .where(F.col("dp") > min_af)
        .join(samples.select("sample_id"), "sample_id", "left_semi")
    )


def varying_positions(
    calls: DataFrame, sites: DataFrame, samples: DataFrame, low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Positions whose share of samples with an alternative base lies strictly between the bounds."""
    total = samples.select("sample_id").distinct().count()
    return (
        calls.join(sites.select("variant_id", "position"), "variant_id")
        .select("position", "sample_id")
        .distinct()
        .groupBy("position")
        .agg(F.count(F.lit(1)).alias("genotype_count"))
        .withColumn("freq", F.col("genotype_count") / F.lit(float(total)))
        .where((F.col("freq") > low) & (F.col("freq") < high))
    )


def allele_counts(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """Samples per alternative base and position, one column per base."""
    bases = [base for base, _ in rules.NUCLEOTIDE_CODES]
    rows = calls.join(sites, "variant_id")
    return count_by_values(rows, ["position", "reference_nucleotide"], "alternative_nucleotide", "sample_id", bases)


def best_calls(calls: DataFrame, varying: DataFrame) -> DataFrame:
    """Code of the strongest clear call per (sample, position); the smaller code wins ties."""
    coded = calls.join(varying.select("variant_id", "position", "alternative_int"), "variant_id")
    return top1_per_group(
        coded, ["sample_id", "position"], [-F.col("dp"), F.col("alternative_int")], ["alternative_int"]
    )


def varying_variants(variant: DataFrame, positions: DataFrame) -> DataFrame:
    """Single-nucleotide variants at the varying positions with their base codes."""
    bases = [base for base, _ in rules.NUCLEOTIDE_CODES]
    return (
        variant.where(F.col("reference_nucleotide").isin(bases) & F.col("alternative_nucleotide").isin(bases))
        .join(positions.select("position"), "position", "left_semi")
        .select(
            "variant_id",
            "position",
            allele_code(F.col("reference_nucleotide")).alias("reference_int"),
            allele_code(F.col("alternative_nucleotide")).alias("alternative_int"),
        )
        .distinct()
    )


def sparse_differences(calls: DataFrame, varying: DataFrame) -> DataFrame:
    """(sample, position, difference from the reference code), non-zero entries only.

    The reference is the same for all samples, so centring makes this equal to the
    dense matrix while only the differences are stored.
    """
    reference = varying.groupBy("position").agg(F.min("reference_int").alias("reference_int"))
    return (
        best_calls(calls, varying)
        .join(reference, "position")
        .select("sample_id", "position", (F.col("alternative_int") - F.col("reference_int")).alias("difference"))
        .where("difference <> 0")
    )


def ranked_positions(varying: DataFrame) -> DataFrame:
    """(place, position, reference_int): the reference row of the matrix, ``place`` counting positions from 0 in their order.

    Positions are sorted in range partitions; a place is the number in the partition plus the sizes of the partitions before, of which
    there is one number each.
    """
    reference = varying.groupBy("position").agg(F.min("reference_int").alias("reference_int"))
    in_order = reference.repartitionByRange("position").sortWithinPartitions("position")
    # The number of a row: its partition in the upper bits, its place there in the lower 33.
    written = cut_lineage(in_order.withColumn("number", F.monotonically_increasing_id()))
    part = F.shiftright("number", 33)
    sizes = written.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"))
    place = F.col("before") + F.col("number").bitwiseAND(F.lit((1 << 33) - 1))
    return written.withColumn("part", part).join(before, "part").select(place.cast("int").alias("place"), "position", "reference_int")


def sparse_matrix(calls: DataFrame, varying: DataFrame, samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reference row, rows of the samples): base codes as differences from one reference row kept apart.

    The rows are (sample_id, places, codes), both arrays in order of place, with an entry only where a sample's strongest clear call is not the
    reference base; samples without any have empty arrays.  No sample is paired with a position it has no call at.
    """
    reference = cut_lineage(ranked_positions(varying))
    entry = F.struct("place", F.col("alternative_int").cast("int").alias("code"))
    found = (
        best_calls(calls.join(samples.select("sample_id"), "sample_id", "left_semi"), varying)
        .join(reference, "position").where("alternative_int <> reference_int")
        .groupBy("sample_id").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    none = F.array().cast("array<int>")
    rows = samples.select("sample_id").distinct().join(found, "sample_id", "left").select(
        "sample_id", F.coalesce("entries.place", none).alias("places"), F.coalesce("entries.code", none).alias("codes")
    )
    return reference, rows


def _in_order(name: str) -> Column:
    """Aggregate: values of the reference row in order of place."""
    return F.transform(F.sort_array(F.collect_list(F.struct("place", name))), lambda c: c[name].cast("int"))


def _written_out() -> Column:
    """Codes of a row: between its differences (``places`` from 0, ``codes``) it takes slices of the reference ``_row``."""
    count = F.size("places")

    def piece(i: Column) -> Column:
        after = F.coalesce(F.get("places", i - 1), F.lit(-1)) + 1  # from 0
        upto = F.coalesce(F.get("places", i), F.size("_row"))
        own = F.when(i < count, F.array(F.get("codes", i))).otherwise(F.array().cast("array<int>"))
        return F.concat(F.slice("_row", after + 1, upto - after), own)

    return F.flatten(F.transform(F.sequence(F.lit(0), count), piece))


def dense_rows(reference: DataFrame, rows: DataFrame) -> DataFrame:
    """(sample_id, codes): sparse rows written out, as long as there are positions.

    The reference row, no longer than any row of the result, goes along as one value.  The number of partitions is given, as the planner would
    merge them by the size of the sparse rows.
    """
    whole = reference.agg(_in_order("reference_int").alias("row")).scalar()
    return rows.repartition(PAIR_SLOTS, "sample_id").withColumn("_row", whole).select("sample_id", _written_out().alias("codes"))


def dense_genotype_calls(calls: DataFrame, varying: DataFrame, samples: DataFrame) -> DataFrame:
    """Base code of every sample at every varying position: its clear call, else the reference base.

    Samples meet blocks of ``PLACES`` positions of the reference row, and each block is written out where it is met; the cells of the
    product are neither exchanged nor sorted.
    """
    reference, rows = sparse_matrix(calls, varying, samples)
    first = F.floor(F.col("place") / PLACES).cast("int") * PLACES
    blocks = reference.groupBy(first.alias("_first")).agg(_in_order("position").alias("_positions"), _in_order("reference_int").alias("_row"))
    # Entries of the block, counted from its first place.
    inside = F.filter(F.arrays_zip("places", "codes"), lambda e: e["places"].between(F.col("_first"), F.col("_first") + (PLACES - 1)))
    met = pair_all(rows, blocks, "sample_id").withColumn("_own", inside).select(
        "sample_id", "_positions", "_row", F.transform("_own", lambda e: e["places"] - F.col("_first")).alias("places"), F.col("_own.codes").alias("codes")
    )
    cells = F.arrays_zip(F.col("_positions").alias("position"), _written_out().alias("integer"))
    return met.select("sample_id", F.inline(cells))


def genotype_matrix(calls: DataFrame, varying: DataFrame, samples: DataFrame) -> DataFrame:
    """One row per sample: base codes ordered by position, as long as there are varying positions."""
    return dense_rows(*sparse_matrix(calls, varying, samples))


def genotype_pca(calls: DataFrame, varying: DataFrame, samples: DataFrame, k: int = 10) -> DataFrame:
    """Scores of every sample on the first k components of the centred base-code matrix."""
    chosen = cut_lineage(samples.select("sample_id").distinct())
    called = calls.join(chosen, "sample_id", "left_semi")
    entries = sparse_differences(called, varying).select(
        "sample_id", F.col("position").alias("column"), F.col("difference").cast("double").alias("value")
    )
    return subspace_pca(entries, chosen, k)


def center_pca(df: DataFrame, key: str, vector: str, k: int = 10) -> DataFrame:
    """Centre (without scaling) an array column and project it on k components.  Keys are unique and of any type."""
    rows = df.select(F.col(key).alias("sample_id"), F.col(vector).alias("_v"))
    entries = rows.select("sample_id", F.posexplode("_v").alias("column", "value")).where("value <> 0")
    values = entries.withColumn("value", F.col("value").cast("double"))
    return subspace_pca(values, rows.select("sample_id"), k).withColumnRenamed("sample_id", key)
