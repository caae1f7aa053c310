"""Session helpers.

The cluster owns the session: library code never changes session options. ``local_session`` is
only for tests and the benchmark, and ``scratch_root`` reads the shared checkpoint folder from the
session.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (never used by the library itself)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakesmith")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the session's ``spark.checkpoint.dir``.

    Without it, the folder of ``SparkContext.setCheckpointDir`` is taken. A ``local`` session (tests)
    with neither gets a folder of its own, since its driver and executors are one process; on a
    cluster a machine-local folder would be invisible to the executors, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lakesmith-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root; ``drop_scratch`` removes it after use."""
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet below the shared scratch folder and return the read-back.

    Cuts the lineage of a frame that several later branches read: it is computed once (an eager
    reliable ``checkpoint()`` would compute an unpersisted plan twice, once to count and once to
    write), a lost executor does not replay its history, and the planner sees real file sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one staged table below the scratch root, once nothing reads it any more."""
    if not path.startswith(scratch_root(spark)):
        raise ValueError(f"{path} is not below the scratch root")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
