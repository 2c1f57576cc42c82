"""Tables written once in the shared folder that the session names for checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares, from ``spark.checkpoint.dir``, with its scheme.

    Where that is unset, a local session (tests) gets a temporary folder of its own; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-"))
        found = _own[0]
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", full).rstrip("/")


def place(spark: SparkSession, kind: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet and read it back: its lineage ends there, it survives the loss of any executor, and columns are still pruned.

    The folder is the cluster's to expire, like its checkpoints.
    """
    spark = df.sparkSession
    path = place(spark, "written")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
