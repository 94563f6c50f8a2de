"""Writers and table maintenance.  Tables are parquet folders on a shared file system."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType, StructType

from strainwise.operators.relational import distinct_on, top1_per_group


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows for writing: rows of a key stay together, but a hot key is split over several tasks."""
    columns = ", ".join(f"`{key}`" for key in keys)
    hint = f"REBALANCE({columns})" if keys else "REBALANCE"
    return df.sparkSession.sql(f"SELECT /*+ {hint} */ * FROM {{rows}}", rows=df)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_nested_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _snapshots(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the complete snapshots below ``root``, oldest first."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    numbers = [int(name.removeprefix("snapshot-")) for name in names if name.startswith("snapshot-")]
    return sorted(n for n in numbers if files.exists(hadoop.Path(f"{root}/snapshot-{n:06d}/_SUCCESS")))


def overwrite_truncate(df: DataFrame, root: str) -> int:
    """Replace the rows of a table, also when ``df`` was computed from that same table.

    The new rows go to the next numbered snapshot; readers switch over once its
    success marker exists, so a lost job leaves the old rows in place.
    """
    done = _snapshots(df.sparkSession, root)
    number = (done[-1] if done else 0) + 1
    df.write.mode("overwrite").parquet(f"{root}/snapshot-{number:06d}")
    return number


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the newest complete snapshot."""
    return spark.read.parquet(f"{root}/snapshot-{_snapshots(spark, root)[-1]:06d}")


def clear_staging(spark: SparkSession, root: str, schema: StructType) -> None:
    """Empty a staging table, keeping its schema."""
    overwrite_truncate(spark.createDataFrame([], schema), root)


def write_partitioned_csv(df: DataFrame, path: str, keys: list[str]) -> None:
    rebalanced(df, *keys).write.mode("overwrite").partitionBy(*keys).option("header", True).csv(path)


def write_single_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """One CSV file for a small table; a table that outgrows one task is written as several files."""
    rebalanced(df).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_report(tables: dict[str, DataFrame], root: str) -> None:
    """One CSV folder per summary table."""
    for name, table in tables.items():
        write_single_csv(table, f"{root}/{name}")


def export_variant_ids(variant: DataFrame, path: str) -> None:
    """Position-sorted, headerless TSV of (chromosome, position, id, reference, alternative).

    Part files follow the order, so reading them by name gives one sorted list.
    """
    ordered_variant_ids(variant).write.mode("overwrite").option("sep", "\t").csv(path)


def ordered_variant_ids(variant: DataFrame) -> DataFrame:
    columns = ["chromosome", "position", "variant_id", "reference_nucleotide", "alternative_nucleotide"]
    return variant.select(*columns).orderBy("position", "chromosome", "variant_id")


def align_to_schema(df: DataFrame, target: StructType) -> DataFrame:
    """Cast and reorder to the target; values that do not fit and columns that are missing become NULL."""
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def split_choices(df: DataFrame, column: str, types: dict[str, str]) -> DataFrame:
    """One column per type for a text column that mixes types (``quality`` -> ``quality_double``, ...)."""
    return df.select("*", *[F.col(column).try_cast(t).alias(f"{column}_{name}") for name, t in types.items()])


def assert_schema(df: DataFrame, required: dict[str, DataType], maps: list[str] = (), allowed: tuple = ()) -> DataFrame:
    """Return ``df`` unchanged, or raise when a field is missing or has another type.

    ``maps`` names columns that must be text-keyed maps of structs with fields of
    the ``allowed`` types only.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name, kind in required.items():
        if name not in fields:
            raise ValueError(f"missing required field {name}")
        if fields[name] != kind:
            raise ValueError(f"field {name} should be {kind.simpleString()}, is {fields[name].simpleString()}")
    for name in maps:
        kind = fields.get(name)
        if not isinstance(kind, MapType) or not isinstance(kind.valueType, StructType):
            raise ValueError(f"field {name} should be a map of structs")
        refused = [f.name for f in kind.valueType.fields if allowed and not isinstance(f.dataType, allowed)]
        if kind.keyType.simpleString() != "string" or refused:
            raise ValueError(f"field {name} has unsupported keys or fields {refused}")
    return df


def upsert_coalesce(current: DataFrame, incoming: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert new keys; for known keys take the incoming value where there is one, else keep the old.

    The result has all columns of ``current``; those that are not updated keep their value, and are NULL for new keys.  Of several incoming
    rows with one key, one is taken whole: the smallest in ``columns``, from the first on, NULL before any value.
    """
    chosen = top1_per_group(incoming, keys, [F.col(name) for name in columns], columns)
    fresh = chosen.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_there"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])

    def merged(name: str) -> Column:
        if name in columns:
            return F.coalesce(f"_{name}", name).alias(name)
        if name in keys:
            return F.when(F.col("_known"), F.col(name)).otherwise(F.col(f"_{name}")).alias(name)
        return F.col(name)

    return current.withColumn("_known", F.lit(True)).join(fresh, same, "full").select(*[merged(c) for c in current.columns])


def insert_if_absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows plus one row for every key that is new: of several the smallest in the further columns."""
    others = [F.col(name) for name in incoming.columns if name not in keys]
    fresh = distinct_on(incoming, keys, others or [F.lit(0)]).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(fresh, allowMissingColumns=True)


def replace_matching_rows(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Drop current rows equal to an incoming row on ``keys`` (NULL equals NULL), then add the incoming rows."""
    wanted = incoming.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return current.join(wanted, same, "left_anti").unionByName(incoming)


def transition_status(
    sample: DataFrame, batch: DataFrame, before: str, after: str, moment: Column | None = None
) -> DataFrame:
    """Set status ``after`` for batch members whose status is ``before``."""
    marked = sample.join(batch.select(F.col("id"), F.lit(True).alias("_in_batch")).distinct(), "id", "left")
    moves = F.coalesce(F.col("_in_batch"), F.lit(False)) & (F.col("bioanalysis_status") == before)
    changed = {"bioanalysis_status": F.when(moves, F.lit(after)).otherwise(F.col("bioanalysis_status"))}
    if "bioanalysis_status_changed_at" in sample.columns:
        stamp = moment if moment is not None else F.current_timestamp()
        changed["bioanalysis_status_changed_at"] = F.when(moves, stamp).otherwise(
            F.col("bioanalysis_status_changed_at")
        )
    return marked.withColumns(changed).select(*sample.columns)


def json_number(value: Column) -> Column:
    """JSON text of a float: five significant digits without trailing zeros, NaN and infinities as strings."""
    text = F.format_string("%.5g", value)
    text = F.regexp_replace(text, r"(\.\d*?)0+(?=$|e)", "$1")
    text = F.regexp_replace(text, r"\.(?=$|e)", "")
    return F.regexp_replace(text, r"^(NaN|-?Infinity)$", '"$1"')


def write_json_documents(documents: DataFrame, path: str) -> None:
    """Documents (folder, name, body) as text lines below ``folder=NNN``; hot folders are split over files."""
    lines = documents.select("folder", F.concat_ws("\t", "name", "body").alias("value"))
    rebalanced(lines, "folder").write.mode("overwrite").partitionBy("folder").text(path)
