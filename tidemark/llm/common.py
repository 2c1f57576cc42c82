"""What the operators share: tables written in the shared folder and a size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scratch import place as new_path
from tidemark.functions.scratch import written as settle

__all__ = ["Scratch", "new_path", "settle", "small"]


class Scratch:
    """Tables written on the way to a result. ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def settle(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, "table")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for text in self.paths:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.paths.clear()


def small(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if a count shows that it has at most ``rows`` rows; otherwise leave the choice to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
