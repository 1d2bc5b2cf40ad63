"""Intermediate tables of one operator call, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heliotab.llm.shipping import ship
from heliotab.workspace import work_dir


class Scratch:
    """Writes tables below one fresh folder; tables no longer needed can be dropped."""

    def __init__(self, spark: SparkSession, purpose: str):
        ship(spark)
        self.spark = spark
        self.root = work_dir(spark, purpose)
        self.paths: dict[int, str] = {}
        self.tables: list[DataFrame] = []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{len(self.tables)}-{name}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append(table)
        self.paths[id(table)] = path
        return table

    def drop(self, table: DataFrame) -> None:
        """Delete a table that this object wrote; nothing may read it any more."""
        path = self.paths.pop(id(table), None)
        if path:
            jvm = self.spark._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
