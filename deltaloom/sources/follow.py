"""Tables read in chunks and then followed by their log, as one stream.

The stream's source tells what a batch is to do: its offset has, for each table, how many of its chunks are finished, and how
many segments of the log. A row is a piece of work (a chunk, a stretch of the log, or how far a table was before), which
a batch resolves with Spark's own readers, so chunks come from any database or files and tasks read them side by side.
Spark notes offsets before a batch and commits them after, so a run that is killed takes up the same pieces again.

A chunk's mark is the log position in the offset that finishes it: the batch reads it after that position was seen, so it
has all changes before. An event of the log is applied if its key's chunk was finished in an earlier batch; else the chunk
will hold it or holds it. Chunks are finished in the order of their keys, so that is one comparison with a bound. A table
whose snapshot stands still (files) names the position it was taken at, and what its log says up to the mark is put on top.

Tables begin pending, are snapshotted, and follow. The log waits until the tables of the first start are read in full; one
that is added later is read beside the moving log. What tables there are, and their chunks, stands in the state folder,
so a table can be added between runs or while one goes on."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from deltaloom import package
from deltaloom.catalog import Change, Schema, TableId
from deltaloom.operators import changelog
from deltaloom.sources.chunks import CHUNK_ROWS, chunks
from deltaloom.sources.metrics import Snapshot
from deltaloom.sources.probes import chunk_bounds
from deltaloom.sources.registry import control_row, jdbc_snapshot, typed_rows
from deltaloom.sources.segments import Segments
from deltaloom.streaming.normalize import JSON
from deltaloom.streaming.runtime import Runtime, Store

WORK = "kind string, name string, a bigint, b bigint"
#: Places of what a snapshot yields, before all that a log can have: a table's creation, then its rows.
CREATED, SNAPSHOT = -(1 << 62), -(1 << 62) + 1
#: In how many batches a snapshot is read at most: a batch has its fixed costs, so a large table's batches take more chunks
#: than chunks.per.batch.
BATCHES = 16
#: What an event of a log holds; sides stay text until the schema that holds for them is known.
EVENT = "before string, after string, op string, ts_ms bigint, ddl string, source struct<db: string, table: string, pos: bigint>"


def listed(root: str, ending: str = "") -> list[str]:
    """The files of a folder by name, without hidden ones; for the source's own process, which has no JVM."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root) if re.match(r"\w+:/", root) else (fs.LocalFileSystem(), root)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.is_file and f.base_name[:1] not in "._" and f.base_name.endswith(ending))


def text_at(root: str, name: str, text: str | None = None) -> str | None:
    """The text of a file, or after writing it: under another name first, so that it is there in full or not at all."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(root) if re.match(r"\w+:/", root) else (fs.LocalFileSystem(), root)
    full = f"{path}/{name}"
    if text is not None:
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/_{name}") as out:
            out.write(text.encode())
        system.move(f"{path}/_{name}", full)
        return text
    if system.get_file_info(full).type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(full) as source:
        return source.read().decode()


class Work(DataSource):
    """Format deltaloom-work; options state (a folder), log (a folder of segments), chunks.per.batch, segments.per.batch,
    snapshot.batches (the most that a table's snapshot takes, whose batches have more chunks if need be; 0: no limit) and
    follow (false: the snapshot is all)."""

    @classmethod
    def name(cls) -> str:
        return "deltaloom-work"

    def schema(self) -> str:
        return WORK

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:  # noqa: N802
        return WorkReader(dict(self.options))


class WorkReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]) -> None:
        self.state, self.log = options["state"], options.get("log", "")
        self.chunks, self.segments = int(options.get("chunks.per.batch", 64)), int(options.get("segments.per.batch", 1024))
        self.batches = int(options.get("snapshot.batches", BATCHES))
        self.follow = str(options.get("follow", "true")) == "true"

    def plans(self) -> list[dict]:
        """Tables and how many chunks they have, in the order in which they were added."""
        return [json.loads(text_at(f"{self.state}/tables", name)) for name in listed(f"{self.state}/tables", ".json")]

    def initialOffset(self) -> dict:  # noqa: N802
        return json.loads(text_at(self.state, "start.json"))

    def latestOffset(self) -> dict:  # noqa: N802
        """The offset after the last one proposed, which is noted first: so none is ever less than one that Spark has."""
        told = text_at(self.state, "proposed.json")
        last = json.loads(told) if told else self.initialOffset()
        now, room = dict(last), self.chunks
        plans = self.plans()
        for plan in plans:
            done = last.get(plan["table"], 0)
            share = -(-plan["chunks"] // self.batches) if self.batches and room else 0
            more = min(max(room, share), plan["chunks"] - done)
            now[plan["table"]], room = done + more, max(0, room - more)
        if self.follow and all(last.get(p["table"], 0) >= p["chunks"] for p in plans if p["first"]):
            now["log"] = max(last["log"], min(len(listed(self.log)) if self.log else 0, last["log"] + self.segments))
        if now != last:
            text_at(self.state, "proposed.json", json.dumps(now))
        return now

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        rows = [("log", "", start["log"], end["log"])]
        for table in sorted(t for t in end if t != "log"):
            rows += [("table", table, start.get(table, 0), end[table])]
        return [InputPartition(r) for r in rows]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield partition.value


class Reader:
    """A table that can be read by chunks: its schema, its chunks' bounds, and the rows of some of them."""

    schema: Schema
    key: str | None
    #: The log position at which a snapshot that stands still was taken, or None where chunks show the table as it is.
    position: int | None = None

    def bounds(self, size: int) -> list[tuple]:
        raise NotImplementedError

    def rows(self, bounds: list[tuple]) -> DataFrame:
        raise NotImplementedError


class TableOfDatabase(Reader):
    def __init__(self, spark: SparkSession, table: TableId, options: Mapping[str, object], key: str | None, keys: Sequence[str], dialect: str) -> None:
        self.spark, self.table, self.options, self.key, self.keys, self.dialect = spark, table, options, key, list(keys), dialect
        whole = jdbc_snapshot(spark, options, str(table), None)
        self.kind = whole.schema
        _, self.schema = typed_rows(spark, options, table, whole, dialect, self.keys)

    def bounds(self, size: int) -> list[tuple]:
        if self.key is None:
            return [(None, None)]
        where = (self.options.get("scan.snapshot.filters") or {}).get(str(self.table))
        return chunk_bounds(self.spark, self.options, str(self.table), self.key, self.kind[self.key].dataType, size, where)

    def rows(self, bounds: list[tuple]) -> DataFrame:
        rows = jdbc_snapshot(self.spark, self.options, str(self.table), self.key, bounds)
        return typed_rows(self.spark, self.options, self.table, rows, self.dialect, self.keys)[0]


class TableOfFiles(Reader):
    def __init__(self, rows: DataFrame, key: str | None, keys: Sequence[str], position: int | None = 0) -> None:
        self.frame, self.key, self.position = rows, key, position
        self.schema = Schema.from_spark(rows.schema, list(keys))

    def bounds(self, size: int) -> list[tuple]:
        if self.key is None:
            return [(None, None)]
        found = chunks(self.frame, self.key, size).orderBy("chunk_id").select("low", "high").collect()
        return [(r["low"], r["high"]) for r in found] or [(None, None)]

    def rows(self, bounds: list[tuple]) -> DataFrame:
        return self.frame if self.key is None else self.frame.where(within(F.col(f"`{self.key}`"), self.frame.schema[self.key].dataType, bounds[0][0], bounds[-1][1]))


def within(key: Column, kind: T.DataType, low: object, high: object) -> Column:
    """Whether a key lies between two bounds; none is in the chunk that is open below."""
    bound = lambda v: F.lit(str(v)).cast(kind) if not isinstance(v, str) else F.lit(v).cast(kind)
    out = F.lit(True) if high is None else F.coalesce(key < bound(high), F.lit(False))
    return (out | key.isNull()) if low is None else out & F.coalesce(key >= bound(low), F.lit(False))


class Follower:
    """The tables of one stream and what its batches do."""

    def __init__(self, spark: SparkSession, runtime: Runtime, state: str, log: str | None, size: int = CHUNK_ROWS) -> None:
        package.ship(spark)
        self.spark, self.runtime, self.state, self.log, self.size = spark, runtime, state.rstrip("/"), log and log.rstrip("/"), size
        self.store = Store(spark, self.state)
        self.tables = Store(spark, f"{self.state}/tables")
        self.readers: dict[str, Reader] = {}
        self.plans: dict[str, dict] = {}

    def segments(self) -> list[str]:
        return Store(self.spark, self.log).names() if self.log else []

    def begin(self, mode: str = "initial", offset: int | None = None, millis: int | None = None) -> None:
        """Notes where the log begins, unless the stream has begun before: for a snapshot, where its tables stand now, or at the
        beginning where they stand still (see add); else by the startup mode."""
        if self.store.read("start.json") is None:
            place = Segments(self.spark, self.log).start(mode, offset, millis) if self.log else 0
            self.store.write("start.json", json.dumps({"log": place}))
            self.store.write("since.json", json.dumps([offset if mode == "specific-offset" else None, millis if mode == "timestamp" else None]))
        self.since = json.loads(self.store.read("since.json"))

    def add(self, table: TableId, reader: Reader, first: bool | None = None, snapshot: bool = True) -> None:
        """Makes a table known: planned once, and from the next batch on read and followed. first: whether the log waits for it, by
        default if the stream hasn't begun."""
        name = str(table)
        self.readers[name] = reader
        first = self.store.read("proposed.json") is None if first is None else first
        known = {json.loads(self.tables.read(n))["table"]: n for n in self.tables.names() if n.endswith(".json")}
        if name not in known:
            bounds = [[None if v is None else v if isinstance(v, int | float | str) else str(v) for v in b] for b in (reader.bounds(self.size) if snapshot else [])]
            self.store.write(f"bounds-{name}", json.dumps(bounds))  # before the plan, which makes the table seen
            known[name] = f"{len(known):06}.json"
            self.tables.write(known[name], json.dumps({"table": name, "chunks": len(bounds), "first": first}))

    def bounds(self, table: str) -> list[tuple]:
        if table not in self.plans:
            self.plans[table] = [tuple(b) for b in json.loads(self.store.read(f"bounds-{table}"))]
        return self.plans[table]

    def progress(self) -> Snapshot:
        """By the last offset that was proposed."""
        last = json.loads(self.store.read("proposed.json") or "{}")
        all_ = {t: len(self.bounds(t)) for t in self.readers}
        done = {t: min(last.get(t, 0), n) for t, n in all_.items()}
        phase = lambda t: "following" if done[t] == all_[t] else "snapshotting" if done[t] else "pending"
        return Snapshot({t: phase(t) for t in all_}, done, {t: all_[t] - done[t] for t in all_}, last.get("log", 0))

    def phases(self) -> dict[str, str]:
        """pending, snapshotting or following, by table."""
        return self.progress().phases

    def events(self, files: list[str], table: TableId) -> DataFrame:
        """A table's events of some segments, sides as texts."""
        lines = self.spark.read.text([f"{self.log}/{f}" for f in files])
        if re.fullmatch(r"\w+", table.table, re.ASCII):  # only lines that can name the table are parsed: such a name has no escapes but \u
            lines = lines.where(F.col("value").contains(table.table) | F.col("value").contains("\\u"))
        e = lines.select(F.from_json("value", EVENT).alias("e")).select("e.*").where(F.col("source.table") == table.table)
        return e.where(F.col("source.db").isNull() | F.col("source.db").isin([p for p in (table.namespace, table.schema) if p])) if table.schema else e

    def changes(self, events: DataFrame, before: Column, after: Column) -> DataFrame:
        """Events as (seq, kind, payload), judged side by side; changes of the schema as they are."""
        op = F.when(F.col("op").isin("c", "r"), "INSERT").when(F.col("op") == "u", "UPDATE").when(F.col("op") == "d", "DELETE")
        offset, millis = self.since
        events = events if offset is None else events.where(F.coalesce("source.pos", "ts_ms") >= offset)
        events = events if millis is None else events.where(F.col("ts_ms") >= millis)
        moved = events.select(op.alias("op"), "before", "after", "ts_ms", F.coalesce("source.pos", "ts_ms").alias("seq"), "ddl", before.alias("b_"), after.alias("a_"))
        rows = moved.where("ddl is null and op is not null")
        rows = changelog.filtered(rows, F.col("b_"), F.col("a_"))
        side = lambda c: F.coalesce(F.col(c), F.lit("null"))
        meta = F.coalesce(F.concat(F.lit('{"op_ts":"'), F.col("ts_ms").cast("string"), F.lit('"}')), F.lit("null"))
        payload = F.concat(F.lit('{"op":"'), F.col("op"), F.lit('","before":'), side("before"), F.lit(',"after":'), side("after"), F.lit(',"meta":'), meta, F.lit("}"))
        told = moved.where("ddl is not null").select("seq", F.lit("schema").alias("kind"), F.col("ddl").alias("payload"))
        return rows.select("seq", F.lit("data").alias("kind"), payload.alias("payload")).unionByName(told)

    def passed(self, reader: Reader, side: str, low: object, high: object) -> Column:
        kind = next(f.dataType for f in reader.schema.spark() if f.name == reader.key)
        return within(F.from_json(side, T.StructType([T.StructField(reader.key, kind)]))[reader.key], kind, low, high)

    def snapshot(self, table: TableId, reader: Reader, bounds: list[tuple], files: list[str]) -> DataFrame:
        """Chunks of a table as (seq, kind, payload), with what its log has on them since the snapshot was taken."""
        rows = changelog.envelope(reader.rows(bounds), seq=F.lit(SNAPSHOT))
        out = rows.select("seq", F.lit("data").alias("kind"), F.to_json(F.struct("op", "before", "after", "meta"), JSON).alias("payload"))
        if reader.position is None or reader.position >= len(files):
            return out
        events, low, high = self.events(files[reader.position :], table), bounds[0][0], bounds[-1][1]
        inside = [self.passed(reader, side, low, high) for side in ("before", "after")] if reader.key else [F.lit(True)] * 2
        return out.unionByName(self.changes(events, *inside).where("kind = 'data'"))

    def batch(self, work: DataFrame, number: int) -> None:
        """Resolves a batch's pieces of work, a row for each table and one for the log, and writes what they yield."""
        pieces = [tuple(r) for r in work.collect()]
        begin, end = next(((a, b) for kind, _, a, b in pieces if kind == "log"), (0, 0))
        files, parts = self.segments()[:end], []
        for kind, name, since, until in sorted(pieces):
            if kind != "table" or name not in self.readers:
                continue
            table, reader, bounds = TableId.parse(name), self.readers[name], self.bounds(name)
            own = []
            if since == 0 and (until or not bounds):
                made = control_row(Change(table, "create.table", schema=reader.schema))
                if until or begin < end:
                    own.append(self.spark.range(1).select(F.lit(CREATED).cast("bigint").alias("seq"), F.lit("schema").alias("kind"), F.lit(made).alias("payload")))
            if until > since:
                own.append(self.snapshot(table, reader, bounds[since:until], files))
            if begin < end and (since or not bounds):
                high = bounds[since][0] if since < len(bounds) else None
                whole = high is None
                sides = [F.lit(True)] * 2 if whole else [self.passed(reader, side, None, high) for side in ("before", "after")]
                own.append(self.changes(self.events(files[begin:], table), *sides))
            parts += [p.select(F.lit(name).alias("table_id"), "seq", "kind", "payload") for p in own]
        if parts:
            self.runtime.batch(reduce(DataFrame.unionByName, parts), number)


def follow(follower: Follower, checkpoint: str, chunks_per_batch: int = 64, segments_per_batch: int = 1024, log: bool = True, interval: str = "1 second") -> StreamingQuery:
    """Starts the stream. A restart from the same checkpoint and state goes on where the last whole batch ended."""
    spark = follower.spark
    spark.dataSource.register(Work)
    options = {"state": follower.state, "log": follower.log or "", "chunks.per.batch": str(chunks_per_batch), "segments.per.batch": str(segments_per_batch), "follow": str(log).lower()}
    work = spark.readStream.format("deltaloom-work").options(**options).load()
    return work.writeStream.foreachBatch(follower.batch).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(processingTime=interval).start()


__all__ = ["Follower", "Reader", "TableOfDatabase", "TableOfFiles", "follow"]
