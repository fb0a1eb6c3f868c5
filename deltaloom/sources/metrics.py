"""How far a snapshot or a stream is: counts observed while it runs, at no extra pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from deltaloom.catalog import TableId


def observed(changes: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """changes, and what a batch run will have seen of them: rows by kind and the last seq."""
    seen = Observation(name)
    counts = [F.count(F.when(F.col("op") == op, 1)).alias(op.lower() + "s") for op in ("INSERT", "UPDATE", "REPLACE", "DELETE")]
    return changes.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, F.max("seq").alias("last_seq")), seen


class Progress(StreamingQueryListener):
    """The rows and batches that each streaming query has done."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event: object) -> None:  # noqa: N802
        self.rows.setdefault(str(event.id), 0)

    def onQueryProgress(self, event: object) -> None:  # noqa: N802
        own = str(event.progress.id)
        self.rows[own] = self.rows.get(own, 0) + event.progress.numInputRows
        self.batches[own] = event.progress.batchId + 1

    def onQueryTerminated(self, event: object) -> None:  # noqa: N802
        pass


@dataclass
class Snapshot:
    """How far the tables of a followed source are: tables by phase, chunks done and left, and segments of the log read."""

    phases: dict[str, str]
    chunks_done: dict[str, int]
    chunks_left: dict[str, int]
    segments: int

    def tables(self, phase: str) -> list[str]:
        return sorted(t for t, p in self.phases.items() if p == phase)


def newly_added(known: list[TableId], found: list[TableId]) -> list[TableId]:
    """Tables that a restart sees for the first time: they are snapshotted before their log is read."""
    return sorted(set(found) - set(known))
