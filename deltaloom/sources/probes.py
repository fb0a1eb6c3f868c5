"""Bounds of chunks by probing a database: each bound is one seek in the key's index, no rows leave the database.

A probe asks for the largest of the next size + 1 keys from a bound on, and how many there are. What it answers is the next
bound, or, if there are fewer, the end. Keys that are numbers and dense enough need no probes: their least, largest and
count, one query, give fixed steps."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from deltaloom.sources.chunks import FACTOR_HIGH, FACTOR_LOW, distribution_factor


class Probes:
    """Queries of single values over one connection."""

    def __init__(self, spark: SparkSession, options: Mapping[str, object]) -> None:
        self.spark, self.options = spark, options
        self.connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(str(options["url"]), str(options.get("user", "")), str(options.get("password", "")))
        product = self.connection.getMetaData().getDatabaseProductName().lower()
        self.limit = "LIMIT {}" if any(x in product for x in ("mysql", "maria", "oceanbase", "tidb")) else "OFFSET 0 ROWS FETCH NEXT {} ROWS ONLY" if "microsoft" in product else "FETCH FIRST {} ROWS ONLY"

    def __enter__(self) -> Probes:
        return self

    def __exit__(self, *_: object) -> None:
        self.connection.close()

    def row(self, text: str, width: int, low: object = None) -> list:
        """The only row of a query, a bound in place of its mark."""
        statement = self.connection.prepareStatement(text)
        try:
            if low is not None:
                statement.setObject(1, low)
            found = statement.executeQuery()
            found.next()
            return [found.getObject(i + 1) for i in range(width)]
        finally:
            statement.close()

    def bounds(self, table: str, key: str, size: int, where: str | None = None) -> Iterator[object]:
        """The lower bounds of all chunks of size rows but the first, in order."""
        rest = f" AND ({where})" if where else ""
        # a chunk may begin anywhere, so each probe starts at the bound before
        begin, low = f"{key} IS NOT NULL", None
        while True:
            least, high, count = self.row(f"SELECT MIN(k), MAX(k), COUNT(*) FROM (SELECT {key} AS k FROM {table} WHERE {begin}{rest} ORDER BY {key} {self.limit.format(size + 1)}) p", 3, low)
            if int(count) <= size:
                return
            if high == least:  # more rows of one key than a chunk has
                (high,) = self.row(f"SELECT MIN({key}) FROM {table} WHERE {key} > ?{rest}", 1, high)
                if high is None:
                    return
            yield high
            begin, low = f"{key} >= ?", high

    def range(self, table: str, key: str, where: str | None = None) -> tuple[object, object, int]:
        low, high, count = self.row(f"SELECT MIN({key}), MAX({key}), COUNT({key}) FROM {table}" + (f" WHERE {where}" if where else ""), 3)
        return low, high, int(count)


def chunk_bounds(spark: SparkSession, options: Mapping[str, object], table: str, key: str, kind: T.DataType, size: int, where: str | None = None) -> list[tuple]:
    """(low, high) of each chunk of a table in a database, the first open below and the last above."""
    with Probes(spark, options) as probes:
        lows = None
        if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType | T.LongType | T.DecimalType):
            low, high, count = probes.range(table, key, where)
            factor = distribution_factor(float(str(low)), float(str(high)), count) if count else 0.0
            if count and FACTOR_LOW <= factor <= FACTOR_HIGH:
                step = max(1, int(factor * size))
                lows = list(range(int(str(low)) + step, int(str(high)) + 1, step))
        if lows is None:
            lows = [v if isinstance(v, int | float | str) else str(v) for v in probes.bounds(table, key, size, where)]
    return list(zip([None, *lows], [*lows, None], strict=True))
