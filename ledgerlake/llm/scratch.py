"""Written tables between the steps of one operator, dropped when no later step reads them."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import fresh_path


class Scratch:
    """Tables in the shared folder; a lost executor costs only the step at hand."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, name: str, df: DataFrame, **options: int) -> DataFrame:
        path = fresh_path(self.spark, name)
        df.write.options(compression="zstd", **options).parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables, and let Spark's cleaner remove the shuffle files of steps that are written by now."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gc.collect()
        time.sleep(2)  # frames that Python no longer has are let go in the background
        jvm.System.gc()
