"""Changes of many regions, put out in the order of their commits.

Each region sends its changes in some order and, now and then, a resolved time: it will send none from before it any more. What
all regions have resolved can go out, in order; the rest waits. A batch's waiting changes and resolved times are written beside
the checkpoint under its number, and it begins from those of the batch before, so one that comes again does the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Resolver:
    """Batches of rows (region, commit, resolved, and what a change holds): resolved is a region's promise, else null. regions is
    how many there are: nothing goes out before each has resolved something. out(changes, batch) takes what goes out."""

    def __init__(self, spark: SparkSession, root: str, regions: int, out: Callable[[DataFrame, int], None]) -> None:
        self.spark, self.root, self.regions, self.out = spark, root.rstrip("/"), regions, out

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/{batch}"

    def _exists(self, path: str) -> bool:
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(found)

    def batch(self, rows: DataFrame, number: int) -> None:
        told = rows.where("resolved is not null").groupBy("region").agg(F.max("resolved").alias("resolved"))
        changes = rows.where("resolved is null").drop("resolved")
        if number and self._exists(self._path("resolved", number - 1)):
            told = told.unionByName(self.spark.read.schema(told.schema).parquet(self._path("resolved", number - 1))).groupBy("region").agg(F.max("resolved").alias("resolved"))
        if number and self._exists(self._path("waiting", number - 1)):
            changes = changes.unionByName(self.spark.read.schema(changes.schema).parquet(self._path("waiting", number - 1)))
        told.coalesce(1).write.mode("overwrite").parquet(self._path("resolved", number))  # a row for each region
        least, seen = self.spark.read.parquet(self._path("resolved", number)).agg(F.min("resolved"), F.count("region")).first()
        ready = F.lit(False) if seen < self.regions else F.coalesce(F.col("commit") <= least, F.lit(False))
        changes.where(~ready).write.mode("overwrite").parquet(self._path("waiting", number))
        self.out(changes.where(ready).distinct().orderBy("commit", "region"), number)  # a region may send a change again


__all__ = ["Resolver"]
