"""Session settings and lineage cutting shared by all operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("mergewell")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset and Spark runs on one machine, a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="mergewell-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


#: Spark's setting (4.1 on) for queries built from now on: their shuffle files are deleted once they have run.
DELETE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _checkpointed(df: DataFrame) -> DataFrame:
    """An eager checkpoint. The shuffle files of its query go at once; else they would stay until the driver collects its garbage, and many small queries would pile them up."""
    conf = df.sparkSession.conf
    before = conf.get(DELETE_SHUFFLES, "false")
    conf.set(DELETE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new query, which takes the setting
    finally:
        conf.set(DELETE_SHUFFLES, before)


#: Rows of a narrow table that one checkpoint file should hold.
ROWS_PER_FILE = 25_000


def cut_lineage(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Materialises df as a reliable checkpoint in the shared folder and returns it without its lineage.

    rows is about how many narrow rows the last step handles: fewer partitions than that many rows call
    for are not written, so that a small table does not become a file for every shuffle partition. More
    rows than the partitions suggest change nothing.
    """
    shared_folder(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_PER_FILE)))
    return _checkpointed(df)


def cut_scan(df: DataFrame, source: DataFrame, share: int = 8) -> DataFrame:
    """As cut_lineage, for narrow rows computed while scanning the wide rows of source: they are gathered from `share` scan tasks into a file."""
    shared_folder(df.sparkSession)
    return _checkpointed(df.repartition(max(1, -(-source.rdd.getNumPartitions() // share))))


#: Bytes of a file, or rows where their number is given, that are worth a task of their own.
TASK_BYTES, TASK_ROWS = 1 << 20, 16


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df, dealt evenly to more tasks where it has fewer than the cluster has cores and is worth it by its files' size, or by rows; else as it is."""
    if rows is None:
        worth = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) // TASK_BYTES
    else:
        worth = rows // TASK_ROWS
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, worth)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
