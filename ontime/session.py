"""Session set-up and the shared scratch folder that staged tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 200_000

_local_scratch: str | None = None


def get_session(app: str = "ontime", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may go without the setting; it then gets one temporary folder per process.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="ontime-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the scratch folder that no earlier run has used."""
    return f"{scratch_dir(spark)}/ontime/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Later passes scan only the columns they need instead of repeating the shuffles above, the lineage is
    cut, and a lost executor costs no recomputation. ``options`` go to the Parquet writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Cache a table for repeated reading in about as many tasks as its row count calls for.

    Iterative fits start one set of tasks per step: a few districts must not be spread over hundreds of them,
    and rows that were staged in one small file must not keep all other cores idle.
    """
    wanted = max(1, -(-rows // ROWS_PER_TASK))
    present = df.rdd.getNumPartitions()
    if wanted <= present:
        spread = df.coalesce(wanted)
    else:
        spread = df.repartition(min(wanted, max(present, df.sparkSession.sparkContext.defaultParallelism)))
    return spread.persist(StorageLevel.MEMORY_AND_DISK)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Stage a table and cache it for an iterative fit."""
    staged = stage(df, name)
    return sized(staged, staged.count())


def hadoop_path(spark: SparkSession, path: str):
    """A path as Hadoop knows it, and its file system."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, fs = hadoop_path(spark, path)
    return fs.exists(location)


def drop_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`stage`, and nothing outside the scratch folder."""
    root = f"{scratch_dir(spark)}/ontime/"
    folders = {f.rsplit("/", 1)[0].removeprefix("file://") for f in df.inputFiles()}
    for folder in folders:
        if root in folder:
            location, fs = hadoop_path(spark, folder)
            fs.delete(location, True)
