"""Session helpers: a local session for tests, the shared work folder, staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "8", partitions: int = 8) -> SparkSession:
    """Session for tests and benches. On a cluster, pass the cluster's own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabml")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # As many partitions as cores: merging them would leave cores idle on small data.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tabml-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the work folder that nothing else uses."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the work folder and read it back.

    Cuts the lineage and survives the loss of executors; used where a result is
    read many times (model fits).
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have the driver find the plans that nothing refers to any more: Spark then removes their shuffle files.

    Else these stay until the driver's memory runs short, and a job of many steps keeps the files of all of them.
    """
    spark._jvm.System.gc()


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table in the work folder that was made by ``new_path`` and that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def small_tasks(spark: SparkSession) -> None:
    """Shuffle partitions are merged up to 8 MB and are 600 before that, where the session doesn't say.

    Spark's 64 MB are compressed bytes as they are read: a step that makes several rows of one, or holds them in
    a hash table, needs some fifty times that in one task, and spills. What skews is split as before. Unions of parts
    that lie by the same key are dealt anew all the same: else all parts are one stage, whose tasks are never merged.
    """
    if spark.conf.get(ADVISORY, None) is None:
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")
        spark.conf.set(ADVISORY, "8m")
        if spark.conf.get("spark.sql.shuffle.partitions", None) is None:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "600")


def bounded_rows(df: DataFrame, limit: int, what: str) -> list:
    """Collect a result that has to be small; fail instead of flooding the driver."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
