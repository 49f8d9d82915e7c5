"""Session helpers: the shared checkpoint folder and a local session for tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a distributed file system path) and is read,
    never replaced.  Only a local session without the setting gets a private temporary folder,
    registered so that later calls agree on it; on any other master this raises, because executors
    do not share the driver's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="fairsketch-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/fairsketch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a path made by :func:`scratch_path` once its last reader is done."""
    if not path.startswith(f"{checkpoint_root(spark)}/fairsketch/"):
        raise ValueError(f"not a scratch path: {path}")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "fairsketch") -> SparkSession:
    """A local session with the settings used by the tests and the bench."""
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
