"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "logharbor", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the cluster's file system, for code that opens files outside the JVM.

    Local paths come back plain.
    """
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        full = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    except AttributeError:      # a remote session has no JVM at hand
        return path
    return full.removeprefix("file:") if full.startswith("file:") else full


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the folder the cluster names in ``spark.checkpoint.dir``; only where that
    setting is absent (tests, a laptop) is a local temporary folder taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="logharbor-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    What is read more than once is computed once, and the planner knows the table's size, by
    which it decides about broadcasting it.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
