"""A log's segments, files in the order of their names, and where in them a position or a time begins.

Positions never fall from one event to the next, nor from one segment to the next; times of segments' first events don't either.
So a search by halves over first lines finds the segment to begin with, and the segments before it are never opened by Spark."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Segments:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.looked: dict[int, tuple[int | None, int | None]] = {}
        path, fs = self._open(self.root)
        found = [s.getPath() for s in fs.listStatus(path) if s.isFile()] if fs.exists(path) and not fs.isFile(path) else []
        self.files = sorted(str(p) for p in found if p.getName()[:1] not in "._") if found or fs.exists(path) and not fs.isFile(path) else [self.root]

    def _open(self, text: str) -> tuple[object, object]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def first(self, i: int) -> tuple[int | None, int | None]:
        """The position and time of a segment's first event; none of an empty segment."""
        if i not in self.looked:
            path, fs = self._open(self.files[i])
            jvm = self.spark.sparkContext._jvm
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
            try:
                line = reader.readLine()
            finally:
                reader.close()
            event = json.loads(line) if line else {}
            own = (event.get("source") or {}).get("pos")
            self.looked[i] = (own if own is not None else event.get("ts_ms"), event.get("ts_ms"))
        return self.looked[i]

    def _before(self, passed: Callable[[tuple], bool | None]) -> int:
        """The last segment that begins before what is sought, from which it may hold it; the first if none does."""
        low, high, best = 0, len(self.files), 0
        while low < high:
            middle = (low + high) // 2
            at = middle
            while at > low and passed(self.first(at)) is None:  # an empty segment begins where the one before it does
                at -= 1
            if passed(self.first(at)):
                low, best = middle + 1, at
            else:
                high = at
        return best

    def at_position(self, position: int) -> int:
        return self._before(lambda first: None if first[0] is None else first[0] < position)

    def at_time(self, millis: int) -> int:
        return self._before(lambda first: None if first[1] is None else first[1] < millis)

    def start(self, mode: str, offset: int | None = None, millis: int | None = None) -> int:
        """The segment from which a startup mode reads."""
        if mode == "specific-offset" and offset is not None:
            return self.at_position(int(offset))
        if mode == "timestamp" and millis is not None:
            return self.at_time(int(millis))
        return len(self.files) if mode == "latest-offset" else 0

    def lines(self, begin: int = 0) -> DataFrame:
        """The lines of the segments from one on."""
        return self.spark.read.text(self.files[begin:]) if self.files[begin:] else self.spark.createDataFrame([], "value string")


__all__ = ["Segments"]
