"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Needed for right results: timestamps are UTC wall time, and a repeated key in a
# JSON object keeps its last value (the default would null the whole record).
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}
# Only for speed and disk. AQE sizes the shuffles from what was really written.
PREFERRED = {
    # The JVM does not compile methods over 8,000 bytes; rather generate smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Records go to one folder per verdict; this many open files spare the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Shuffle files go when their query has ended, not when the driver next collects garbage:
    # a job of several epochs would keep those of all of them.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Row groups of staged copies. A task reads whole row groups, so a copy written by few tasks
# still gives many of them work.
ROW_GROUP_BYTES = 8 << 20

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller built."""
    for name, value in {**REQUIRED, **PREFERRED}.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = 8, *, memory: str = "8g", **settings: str) -> SparkSession:
    """A session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("changefeed")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        # Recording a call site for every Column costs more than planning a query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    # One process, so its own folder is one that all executors share.
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="changefeed-")
    return _LOCAL[application]


def stage(df: DataFrame, name: str, *, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a plan reads the same expensive frame more than once, or where a
    value must not change when a lost task is computed again. The copy is a
    Parquet table, so each later read takes only the columns it needs.
    """
    spark = df.sparkSession
    target = path or f"{shared_dir(spark)}/changefeed/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def _filesystem(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return bool(filesystem.exists(target))


def numbered_folders(spark: SparkSession, path: str, prefix: str) -> set[int]:
    """The numbers n of the folders ``prefix=n``; a listing, no Spark job."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return set()
    names = [status.getPath().getName() for status in filesystem.listStatus(target)]
    start = f"{prefix}="
    return {int(name[len(start) :]) for name in names if name.startswith(start)}


def delete_path(spark: SparkSession, path: str) -> None:
    filesystem, target = _filesystem(spark, path)
    filesystem.delete(target, True)
