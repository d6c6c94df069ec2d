"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on (UTC) and leave sizes to whoever started the session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = prepare(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder every node can reach, as the cluster names it; a local one only where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_dir(context.applicationId)


def new_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"tidemark-{name}-{uuid.uuid4().hex}")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder of any store Spark reaches; none where there is no folder."""
    folder, store = _folder(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(folder)) if store.exists(folder) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote for its own use."""
    folder, store = _folder(spark, path)
    store.delete(folder, True)
