"""Session settings and the shared working area used by jobs that write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants.  Partition counts are left to the cluster and to AQE.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}

#: What a task reads of a shuffle where AQE merges partitions; a session that names a size keeps it.  Calls are narrow rows that take ten times
#: their compressed size while they are sorted and grouped, so Spark's 64 MB would be most of a GB in one task.
TASK_SIZE = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")


def configure(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings to an existing session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    spark.conf.set(TASK_SIZE[0], spark.conf.get(*TASK_SIZE))
    return spark


def build_session(app: str = "strainwise", master: str | None = None, partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return configure(builder.config("spark.ui.enabled", "false").getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is only accepted in local mode, where driver and
    executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="strainwise-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def work_area(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared root for one run."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Losing executors then costs no recomputation, and the planner knows the size of
    what was written.
    """
    path = work_area(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that deals both sides out by the key and broadcasts neither.

    The planner guesses sizes from those of files, which says little of what an explode or arrays make of them; a table that grows with the
    input could be sent to the driver whole.
    """
    return df.hint("merge")


class Stages:
    """Frames written to the shared folder for one run.  What a run has no more use for is dropped, and the rest goes when it ends;
    so its result must be written elsewhere before."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.held: list[tuple[DataFrame, str]] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *failure) -> None:
        for frame, _ in list(self.held):
            self.drop(frame)

    def cut(self, df: DataFrame) -> DataFrame:
        """As :func:`cut_lineage`."""
        path = work_area(self.spark, "stage")
        df.write.parquet(path)
        frame = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((frame, path))
        return frame

    def keep(self, frame: DataFrame) -> DataFrame:
        """Leave what ``frame`` reads when the run ends."""
        self.held = [e for e in self.held if e[0] is not frame]
        return frame

    def drop(self, frame: DataFrame) -> None:
        """Remove what ``frame`` reads; frames that other code wrote stay."""
        for entry in [e for e in self.held if e[0] is frame]:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(entry[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.held.remove(entry)
