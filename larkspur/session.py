"""Sessions for local work, and the shared folder a cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "larkspur", memory: str = "8g",
                  partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own.

    It names a checkpoint folder of this machine, and files in it go when
    nothing refers to them any more.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="larkspur-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where the single
    machine is the whole cluster. A cluster without the setting is an error:
    a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="larkspur-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point checkpoints at the shared folder unless the context has one."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = shared_dir(spark)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from those files.

    Iterative fits ship their input's lineage with every job; from here on it
    is a file read, and a lost executor costs only that read.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into Parquet of the shared folder: for wide tables that are read by columns, several times."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(table: DataFrame, least: int = 0) -> DataFrame:
    """A computed table over enough tasks for the cluster, at least ``least``; one that has them is left alone.

    Small joins and files of one row group leave a table in one or two
    partitions, and every pass of an iterative fit would run in as many tasks.
    """
    wanted = max(2 * table.sparkSession.sparkContext.defaultParallelism, least)
    return table if table.rdd.getNumPartitions() >= wanted else cut_lineage(table.repartition(wanted))
