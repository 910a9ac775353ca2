"""Session defaults, the shared work folder and one-time materialisation."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, name: str = "tidemark", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. On a cluster, use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach, from `spark.checkpoint.dir`.

    Only a session in one process may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidemark-{application_id}-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def state_on_disk(spark: SparkSession) -> None:
    """Streams that are started from here on hold their state in RocksDB, whose memory is bounded per
    executor, and not in the executors' heaps. What the session has set itself stays."""
    store = "spark.sql.streaming.stateStore"
    wanted = {
        f"{store}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        f"{store}.rocksdb.boundedMemoryUsage": "true",
        f"{store}.rocksdb.maxMemoryUsageMB": "256",
    }
    for name, value in wanted.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def written_to(df: DataFrame, path: str) -> DataFrame:
    """Write the frame to a folder, in place of what is there, and read it back.

    For intermediate tables that several later steps read: they are computed once, survive the
    loss of executors, and have a known size when the next join is planned.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
