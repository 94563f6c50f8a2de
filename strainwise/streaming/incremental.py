"""Incremental jobs: Structured Streaming over new files, and key bookmarks over tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strainwise.operators.relational import distinct_on
from strainwise.session import Stages, cut_lineage
from strainwise.sources.sinks import overwrite_truncate, read_snapshot

BATCH = "load_batch"


def stream_files(
    spark: SparkSession, path: str, schema, file_format: str = "csv", options: dict | None = None
) -> DataFrame:
    """New files below ``path`` as a stream."""
    return spark.readStream.format(file_format).schema(schema).options(**(options or {})).load(path)


def incremental_load(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> None:
    """Transform everything that arrived since the last run and append it to ``target``.

    The checkpoint remembers which files were taken.  Each micro-batch writes its own
    folder and overwrites it when replayed after a failure, so rows arrive exactly once.
    """

    def append(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """Rows of an incrementally loaded table."""
    return spark.read.parquet(target).drop(BATCH)


def load_unseen(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], keys: list[str], target: str, checkpoint: str
) -> None:
    """As :func:`incremental_load`, but rows whose key an earlier batch loaded are skipped.

    NULL is a key like any other.  Of several rows with one key the smallest in all further columns stays, so a replay
    of a batch gives the same rows.
    """

    def append(batch: DataFrame, number: int) -> None:
        rows = transform(batch)
        others = [F.col(name) for name in rows.columns if name not in keys]
        rows = distinct_on(rows, keys, others or [F.lit(0)])
        if number > 0:
            # Batches before this one, by the partition column: a replay does not see its own earlier attempt.
            kind = StructType([*rows.schema.fields, StructField(BATCH, LongType())])
            earlier = batch.sparkSession.read.schema(kind).parquet(target).where(F.col(BATCH) < number)
            seen = earlier.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(seen[f"_{k}"]) for k in keys])
            rows = rows.join(seen, same, "left_anti")
        rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={number}")

    query = (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def after(keys: list[str], mark: dict) -> Column:
    """Key tuple comes after the mark, compared column by column."""
    steps = []
    for i, key in enumerate(keys):
        equal = [F.col(k) == mark[k] for k in keys[:i]]
        steps.append(reduce(lambda a, b: a & b, [*equal, F.col(key) > mark[key]]))
    return reduce(lambda a, b: a | b, steps)


def scan_incremental(table: DataFrame, keys: list[str], state: str) -> tuple[DataFrame, Callable[[], object]]:
    """Rows beyond the stored key mark, and a function that moves the mark once they are processed.

    The new mark is the highest key at the time of the scan; rows that arrive later lie beyond it and are left to the next
    run.  The mark is one row; the filters on it are pushed into the scan.  A NULL in a key is refused, as it has no place
    in the order.
    """
    spark = table.sparkSession
    try:
        mark = read_snapshot(spark, state).first().asDict()
    except IndexError:
        mark = None
    beyond = table if mark is None else table.where(after(keys, mark) | missing(keys))
    found = beyond.agg(F.max(F.struct(*keys)).alias("mark"), F.count_if(missing(keys)).alias("missing")).first()
    if found["missing"]:
        raise ValueError(f"{found['missing']} rows have NULL in the key {keys}")
    if found["mark"] is None:
        return table.limit(0), lambda: None
    highest = found["mark"].asDict()
    fresh = table.where(~after(keys, highest))
    if mark is not None:
        fresh = fresh.where(after(keys, mark))
    kept = spark.createDataFrame([tuple(highest[k] for k in keys)], table.select(*keys).schema)
    return fresh, lambda: overwrite_truncate(kept, state)


def missing(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def scan_with_late_rows(
    table: DataFrame, keys: list[str], state: str, window
) -> tuple[DataFrame, Callable[[], object]]:
    """Rows that no earlier run has taken, and a function that marks them as taken.

    Rows may arrive late by up to ``window`` (a number, or an interval column) below the highest first key so far; the range is read again,
    and what an earlier run took from it is left out by an exact anti join with the kept keys.  Later ones are not found.  The kept keys
    are those of the window, one snapshot, so mark and keys move together.  The rows are written once, so what is marked is what was
    returned, whatever arrives in between.  A row with a key that was taken before is not new; NULL in a key is refused.
    """
    spark, lead = table.sparkSession, F.col(keys[0])

    def since(frame: DataFrame) -> Column | None:
        top = frame.agg(F.max(lead)).first()[0]
        return None if top is None else lead >= F.lit(top) - window

    try:
        seen = read_snapshot(spark, state)
    except IndexError:
        seen = None
    fresh = table if seen is None else table.where(since(seen) | missing(keys)).join(seen, keys, "left_anti")
    fresh = cut_lineage(fresh.select(*table.columns))
    refused = fresh.where(missing(keys)).count()
    if refused:
        raise ValueError(f"{refused} rows have NULL in the key {keys}")

    def commit() -> int | None:
        taken = fresh.select(*keys) if seen is None else seen.unionByName(fresh.select(*keys))
        kept = since(taken)
        return None if kept is None else overwrite_truncate(taken.where(kept).distinct(), state)

    return fresh, commit


def sheet_rows(lines: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Rows of CSV lines whose columns are all text; header and blank lines go.

    A line with a wrong number of cells, or a header that starts as ``schema`` does but goes on differently, is an error.  A cell holds no line breaks.
    """
    cells = F.from_csv(F.col(value), schema, {"mode": "FAILFAST"})
    names = StructType.fromDDL(schema).fieldNames()
    same = [F.coalesce(cells[name] == F.lit(name), F.lit(False)) for name in names]
    refused = F.raise_error(F.concat(F.lit("not the header of the sheet: "), F.to_json(cells))).cast("boolean")
    header = F.when(reduce(lambda a, b: a & b, same), F.lit(True)).when(same[0], refused).otherwise(False)
    # Only lines with the name of the first column in them can be headers; the others are taken apart once, for their cells.
    if not set(names[0]) & set('"\\'):
        header = F.when(F.col(value).contains(names[0]), header).otherwise(False)
    return lines.where(F.trim(value) != "").where(~header).select(cells.alias("cells")).select("cells.*")


def arrival_triggered_ingest(
    spark: SparkSession,
    inbox: str,
    sheets: dict[str, Callable[[DataFrame], DataFrame]],
    schemas: dict[str, str],
    target: str,
    checkpoint: str,
) -> None:
    """Parse submission files as they arrive: one stream over the sheet folders of the inbox feeds one table per sheet.

    The files of a submission that arrive together are one batch.  Every table has a folder per batch, which a replay overwrites; so after a
    failure between two tables the batch is loaded again as a whole, and each row stands once.
    """
    # A pattern would be tried at every character of the path, for every line.
    folder = F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -2), "/", 1)
    lines = stream_files(spark, f"{inbox}/{{{','.join(sheets)}}}", "value string", "text").select("value", folder.alias("sheet"))

    def load(batch: DataFrame, number: int) -> None:
        for sheet, parse in sheets.items():
            with Stages(batch.sparkSession) as stages:
                # Parsers read their rows several times; the lines are read once.
                rows = stages.cut(sheet_rows(batch.where(F.col("sheet") == sheet), schemas[sheet]))
                parse(rows).write.mode("overwrite").parquet(f"{target}/{sheet}/{BATCH}={number}")

    query = (
        lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
