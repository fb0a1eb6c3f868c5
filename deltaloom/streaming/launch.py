"""From a definition to a running stream: its source's tables are read in chunks and followed by their log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from deltaloom.catalog import TableId
from deltaloom.plans.definition import PipelineDef
from deltaloom.sinks.registry import Sink, open_sink
from deltaloom.sources.chunks import CHUNK_ROWS
from deltaloom.sources.follow import Follower, Reader, TableOfDatabase, TableOfFiles, follow
from deltaloom.sources.metrics import Progress
from deltaloom.sources.registry import table_names
from deltaloom.sources.selectors import Selectors
from deltaloom.streaming.runtime import Runtime

#: Startup modes that begin with a snapshot.
SNAPSHOTS = ("initial", "snapshot")


def reader_of(spark: SparkSession, options: Mapping[str, object], name: str) -> Reader:
    table, keys = TableId.parse(name), (options.get("keys") or {}).get(name) or []
    key = (options.get("chunk-key") or {}).get(name) or (keys or [None])[0]
    if options["type"] == "files":
        style = str(options.get("format", "parquet"))
        return TableOfFiles(spark.read.format(style).load(f"{str(options['path']).rstrip('/')}/{table.table}.{style}"), key, keys, int(options.get("snapshot.position", 0)))
    if key is None and not options.get("allow-no-key"):
        raise ValueError(f"{name} has no primary key: give a chunk key")
    return TableOfDatabase(spark, table, options, key, keys, str(options["type"]))


def launch(spark: SparkSession, definition: PipelineDef, checkpoint: str, sink: Sink | None = None, interval: str = "1 second") -> tuple[StreamingQuery, Follower]:
    """Starts a definition's stream, or takes it up from its checkpoint, where tables that it names for the first time are read
    beside the log. The follower tells how far it is and takes further tables."""
    if len(definition.sources) != 1:
        raise ValueError("a stream has one source")
    one = definition.sources[0]
    options = {"type": one.type, **one.options}
    mode, checkpoint = str(options.get("scan.startup.mode", "initial")), checkpoint.rstrip("/")
    sink = sink or open_sink(spark, {"type": definition.sink.type, **definition.sink.options})
    spark.streams.addListener(progress := Progress())
    made = Follower(spark, Runtime(spark, definition, sink, checkpoint), f"{checkpoint}/source", options.get("log.path"), int(options.get("scan.incremental.snapshot.chunk.size", CHUNK_ROWS)))
    made.listener = progress
    made.begin(mode, options.get("scan.startup.offset"), options.get("scan.startup.timestamp-millis"))
    names = list(options.get("names") or options.get("keys") or []) if one.type == "files" else table_names(spark, options)
    keep = Selectors(str(options["tables"]), options.get("tables.exclude")) if one.type == "files" and options.get("tables") else None
    for name in names:
        if keep is None or keep.matches(TableId.parse(name)):
            made.add(TableId.parse(name), reader_of(spark, options, name), snapshot=mode in SNAPSHOTS)
    return follow(made, checkpoint, int(options.get("chunks.per.batch", 64)), int(options.get("segments.per.batch", 1024)), mode != "snapshot", interval), made


__all__ = ["launch", "reader_of"]
