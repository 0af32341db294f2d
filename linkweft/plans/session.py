"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans of this package count on.  All are defaults or
# safe to set per session; nothing here depends on the cluster size.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", memory: str = "16g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("linkweft")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folder of each local application that has no setting; driver and executors are one process there.
_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without the setting a local session, which is one process, gets a folder of its own;
    on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="linkweft-")
    return _LOCAL_DIRS[context.applicationId]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_dir(spark)}/linkweft/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df` written as Parquet below the shared folder, and read from there."""
    folder = work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
