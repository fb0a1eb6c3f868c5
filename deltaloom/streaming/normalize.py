"""Full changelogs from upserts: logs that tell a key's new row, but not the one before, or tell it more than once.

Each key's last row is kept as state. A change becomes an insertion, an update with the row before, or a deletion with all
of the row; one that changes nothing, or is older than what the key has seen, yields nothing. A stream keeps the rows in
the state store, RocksDB where the session says so, so a restart goes on with them; a bounded changelog takes them from the
key's change before."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from deltaloom import package
from deltaloom.operators.changelog import META

#: Times and rows in texts, to the microsecond and with NULLs.
JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastRows(StatefulProcessor):
    """A key's last row (none after a deletion) and the seq that it is of. A key's changes of one batch are put in order; the
    source's limits bound a batch."""

    def __init__(self, keep_ms: int | None = None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "row string, seq bigint", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timer_values: object) -> Iterator[Row]:  # noqa: N802
        row, at = self.last.get() if self.last.exists() else (None, None)
        for r in sorted(rows, key=lambda r: r.seq):
            if at is not None and r.seq <= at:
                continue
            after, at = r.after, r.seq
            if after != row:
                op = "INSERT" if row is None else "DELETE" if after is None else "UPDATE"
                yield Row(op=op, before=row, after=after, meta=r.meta, seq=r.seq)
            row = after
        self.last.update((row, at))

    def close(self) -> None:
        pass


def key_of(changes: DataFrame, keys: Sequence[str]) -> Column:
    """The key as a text; an upsert has it in the row after, a deletion in the one before."""
    return F.to_json(F.struct(*[F.coalesce(F.col(f"after.`{k}`"), F.col(f"before.`{k}`")).alias(k) for k in keys]), JSON)


def normalized(changes: DataFrame, keys: Sequence[str], keep_ms: int | None = None) -> DataFrame:
    """The full changelog of upserts (a changelog whose rows before may be missing). keep_ms: how long a stream remembers a key
    that doesn't change, for ever if not given; a key that comes again later is new."""
    if not changes.isStreaming:
        turn = Window.partitionBy(key_of(changes, keys)).orderBy("seq")
        after = F.when(F.col("op") != "DELETE", F.col("after"))
        placed = changes.select(after.alias("after"), F.lag(after).over(turn).alias("before"), "meta", "seq", F.lag("seq").over(turn).alias("earlier"))
        op = F.when(F.col("before").isNull(), "INSERT").when(F.col("after").isNull(), "DELETE").otherwise("UPDATE")
        return placed.where(~F.col("before").eqNullSafe(F.col("after")) & (F.col("earlier").isNull() | (F.col("seq") > F.col("earlier")))).select(op.alias("op"), "before", "after", "meta", "seq")
    package.ship(changes.sparkSession)
    kind = changes.schema["after"].dataType
    texts = changes.select(key_of(changes, keys).alias("key"), F.when(F.col("op") != "DELETE", F.to_json("after", JSON)).alias("after"), F.to_json("meta").alias("meta"), "seq")
    made = texts.groupBy("key").transformWithState(LastRows(keep_ms), "op string, before string, after string, meta string, seq bigint", "append", "processingTime" if keep_ms else "none")
    return made.select("op", F.from_json("before", kind).alias("before"), F.from_json("after", kind).alias("after"), F.from_json("meta", META).alias("meta"), "seq")


__all__ = ["ROCKSDB", "LastRows", "normalized"]
