"""Streams of changes and schema changes, written batch by batch.

The stream is one DataFrame of (table_id, seq, kind, payload): a row's kind is data, its payload a JSON change
{op, before, after}; or schema, its payload a schema change (see sources.registry.control_row). Payloads stay text until
a batch reads them with the schema that holds for their place: schema changes cut a batch into segments, which are
written in order, so a sink has all rows before a change when it is applied. The registry of schemas is kept as JSON
beside the checkpoint, with the batch it is of: a batch that comes again starts from the registry before it. What it sends
to a sink that keeps schemas is noted there as well, before (meant) and after (done): a change that was done isn't sent
again, one that was meant is taken up where the sink's own catalog says it was left, and one that the sink refused is
refused again."""

from __future__ import annotations

import itertools
import os
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from deltaloom.catalog import Change, Schema, TableId, apply_change, difference, is_redundant, least_common_schema, transformed_change
from deltaloom.functions.udfs import registered
from deltaloom.operators import changelog, route
from deltaloom.operators.evolve import Registry, SchemaEvolution, coerced
from deltaloom.operators.transform import Transform, has_wildcard, referenced_columns, rule_for
from deltaloom.plans.definition import PipelineDef
from deltaloom.sinks.registry import Sink
from deltaloom.sources.registry import control_change, control_row
from deltaloom.store import Store

ROW = "table_id string, seq bigint, kind string, payload string"


def table_of(origin: str) -> TableId:
    return TableId.parse(origin.rpartition("|")[2])


class Runtime:
    """Applies a definition to batches of the stream.

    Rows may name the reader they come from (a column reader): parallel readers of one table each have its schema as they know
    it, and change it in any order. Their rows are read by the schema that held for them there, and written by the least common
    one of all readers."""

    def __init__(self, spark: SparkSession, definition: PipelineDef, sink: Sink, checkpoint: str, writers: int = 8) -> None:
        """writers: how many tables are written at a time."""
        self.writers = writers
        self.spark, self.definition, self.sink = spark, definition, sink
        self.store = Store(spark, f"{checkpoint.rstrip('/')}/registry")
        self.udfs = registered(definition.udfs, definition.models)
        sink.writer = checkpoint.rstrip("/")

    def registry_before(self, batch: int) -> Registry:
        found = [int(n) for n in self.store.names() if n.isdigit() and int(n) < batch]
        text = self.store.read(str(max(found))) if found else None
        return Registry.load(text) if text else Registry()

    def batch(self, rows: DataFrame, number: int) -> None:
        registry = self.registry_before(number)
        d = self.definition
        evolution = SchemaEvolution(d.config["schema.change.behavior"], list(d.sink.include) if d.sink.include else None, list(d.sink.exclude) if d.sink.exclude is not None else None, registry)
        # a reader's rows of a table lie together, so a job for them skips the cached batches of others
        origin = F.concat_ws("|", "reader", "table_id") if "reader" in rows.columns else F.col("table_id")
        rows, self.ends = rows.withColumn("origin", origin).sortWithinPartitions("origin", "kind").persist(), {}
        try:
            # schema changes are few; they cut the batch
            changes = [(r["origin"], r["seq"], control_change(r["payload"])) for r in rows.where("kind = 'schema'").orderBy("seq", "origin").collect()]
            firsts = dict(sorted(map(tuple, rows.where("kind = 'data'").groupBy("origin").agg(F.min("seq")).collect())))
            part, since = 0, dict.fromkeys(firsts)
            for origin, seq, change in changes:
                # the sink of parallel readers only ever gets wider, so their rows wait for the end
                if origin in since and firsts[origin] < seq and "|" not in origin:
                    self.segment(rows, evolution, origin, since[origin], seq, number, part)
                    part += 1
                if origin in since and "|" not in origin:
                    since[origin] = seq
                elif origin in since:
                    self.ends.setdefault(origin, []).append((seq, registry.sources.get(origin + "/raw")))
                self.schema_change(evolution, change, number, part, origin)
                part += 1
            last: list[list[tuple]] = []
            for origin in firsts:
                pieces = [(origin, since[origin], None, None)]
                if origin in self.ends:
                    cuts = [None, *(seq for seq, _ in self.ends[origin]), None]
                    schemas = [*(schema for _, schema in self.ends[origin]), None]
                    pieces = [(origin, a, b, schema) for a, b, schema in zip(cuts[:-1], cuts[1:], schemas, strict=True) if schema or b is None]
                last.append([(*p, part + i) for i, p in enumerate(pieces)])
                part += len(pieces)
            with ThreadPoolExecutor(max(1, min(self.writers, self.sink.together, len(last)))) as pool:  # no schema changes any more: tables don't wait for one another
                work = inheritable_thread_target(self.spark)(lambda group: [self.segment(rows, evolution, o, a, b, number, at, schema) for o, a, b, schema, at in group])
                done = [pool.submit(work, group) for group in self.apart(last)]
            for one in done:
                one.result()
        finally:
            rows.unpersist()
        registry.version = number
        self.store.write(str(number), registry.dump())
        for name in self.store.names():
            if name.startswith("change-") and int(name.split("-")[1]) < number:
                self.store.delete(name)

    def apart(self, pieces: list[list[tuple]]) -> list[list[tuple]]:
        """Pieces of work in groups that write to different sink tables."""
        groups: list[tuple[set[str], list[tuple]]] = []
        for own in pieces:
            sinks, work = {str(t) for t in route.targets(table_of(own[0][0]), self.definition.routes, self.definition.config["route-mode"])}, list(own)
            for group in [g for g in groups if g[0] & sinks]:
                groups.remove(group)
                sinks, work = sinks | group[0], group[1] + work
            groups.append((sinks, sorted(work, key=lambda w: w[-1])))
        return [work for _, work in groups]

    def send(self, step: Change, number: int, part: int, turn: int) -> None:
        """A sink's change, once; turn tells apart the changes that one of the source becomes."""
        if not self.sink.keeps_schemas or step.kind == "create.table":  # a table that is there isn't made again
            self.sink.apply(step)
            return
        name, text = f"change-{number}-{part}-{step.table}-{turn}", control_row(step)
        noted, _, state = (self.store.read(name) or "").partition("\n")
        known = noted == text
        if known and state == "done":
            return
        if known and state.startswith("refused"):
            raise ValueError(state)
        self.store.write(name, f"{text}\nmeant")
        try:
            self.sink.apply(step, again=known)
        except Exception as wrong:
            if self.definition.config["schema.change.behavior"] == "TRY_EVOLVE":
                self.store.write(name, f"{text}\nrefused: {str(wrong)[:200]}")
            raise
        self.store.write(name, f"{text}\ndone")

    def schema_change(self, evolution: SchemaEvolution, change: Change, number: int, part: int, source: str) -> None:
        """A source's change as its transform lets it through, for each sink table."""
        d = self.definition
        rule = rule_for(change.table, d.transforms)
        registry = evolution.registry
        if rule is None:
            seen = change
        elif change.kind == "create.table":
            seen = Change(change.table, "create.table", schema=self.projected_schema(change.table, change.schema))
        else:
            seen = transformed_change(change, has_wildcard(rule), referenced_columns(rule, registry.sources[source + "/raw"]))
        raw = registry.sources.get(source + "/raw")
        if not is_redundant(raw, change):
            registry.sources[source + "/raw"] = apply_change(raw, change)
        if seen is not None:
            for sink in route.targets(change.table, d.routes, d.config["route-mode"]):
                if "|" in source:
                    self.widen(evolution, seen, source, sink, number, part)
                    continue
                change_of = str(change.table)
                own = Registry({change_of: registry.sources.get(f"{source}>{sink}")} if registry.sources.get(f"{source}>{sink}") else {}, registry.sinks)
                step = SchemaEvolution(evolution.behavior, registry=own)
                step.accepted = evolution.accepted
                turns = itertools.count()
                step.arrive(seen, sink, lambda one, turns=turns: self.send(one, number, part, next(turns)))
                if own.sources.get(change_of):
                    registry.sources[f"{source}>{sink}"] = own.sources[change_of]

    def widen(self, evolution: SchemaEvolution, change: Change, source: str, sink: TableId, number: int, part: int) -> None:
        """One of parallel readers has changed its schema: the sink's becomes the least common one of all readers'. Readers may
        do so in any order, so nothing is dropped."""
        registry, name = evolution.registry, f"{source}>{sink}"
        if change.kind != "create.table" and evolution.behavior == "EXCEPTION":
            raise ValueError(f"{change.kind} of {change.table}: schema changes aren't allowed")
        if not is_redundant(registry.sources.get(name), change):
            registry.sources[name] = apply_change(registry.sources.get(name), change)
        if change.kind != "create.table" and evolution.behavior == "IGNORE":
            return
        own = registry.sinks.get(str(sink))
        everyone = [schema for key, schema in sorted(registry.sources.items()) if key.endswith(f">{sink}")]
        for turn, step in enumerate(difference(sink, own, reduce(least_common_schema, everyone, own))):
            if step.kind != "drop.column" and step.kind in evolution.accepted:
                self.send(step, number, part, turn)
                registry.sinks[str(sink)] = apply_change(registry.sinks.get(str(sink)), step)

    def empty(self, schema: Schema) -> DataFrame:
        row = T.StructType([T.StructField(f.name, f.dataType) for f in schema.spark()])
        return self.spark.createDataFrame([], T.StructType([T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row), T.StructField("meta", changelog.META), T.StructField("seq", T.LongType())]))

    def projected_schema(self, table: TableId, schema: Schema) -> Schema:
        rule = rule_for(table, self.definition.transforms)
        return schema if rule is None else Transform(rule, table, schema, self.empty(schema), self.udfs).output_schema()

    def segment(self, rows: DataFrame, evolution: SchemaEvolution, origin: str, after: int | None, before: int | None, number: int, part: int, schema: Schema | None = None) -> None:
        """Writes a table's rows between two schema changes; schema is the one they were written under, by default the newest."""
        own, registry, source = rows.where((F.col("origin") == origin) & (F.col("kind") == "data")), evolution.registry, table_of(origin)
        own = own if after is None else own.where(F.col("seq") >= after)
        own = own if before is None else own.where(F.col("seq") < before)
        schema = schema or registry.sources.get(origin + "/raw")
        if schema is None:
            raise ValueError(f"rows of {source} came before its creation")
        row = T.StructType([T.StructField(f.name, f.dataType) for f in schema.spark()])
        kind = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row), T.StructField("meta", changelog.META)])
        changes = own.select(F.from_json("payload", kind).alias("c"), "seq").select("c.*", "seq")
        rule = rule_for(source, self.definition.transforms)
        made, out = (changes, schema) if rule is None else ((t := Transform(rule, source, schema, changes, self.udfs)).run(), t.output_schema())
        for sink in route.targets(source, self.definition.routes, self.definition.config["route-mode"]):
            target = registry.sinks[str(sink)]
            sides = {s: F.when(F.col(s).isNotNull(), coerced(F.col(s), out, target, evolution.behavior != "EVOLVE")).alias(s) for s in ("before", "after")}
            self.sink.write(sink, made.select("op", sides["before"], sides["after"], "meta", "seq"), target, number, part)


def start(spark: SparkSession, stream: DataFrame, definition: PipelineDef, sink: Sink, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Starts the stream (rows as ROW). A restart from the same checkpoint goes on where the last whole batch ended."""
    runtime = Runtime(spark, definition, sink, checkpoint)
    writer = stream.writeStream.foreachBatch(runtime.batch).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").queryName(os.path.basename(str(definition.config["name"])).replace(" ", "_"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def file_stream(spark: SparkSession, path: str) -> DataFrame:
    """The stream of JSON-lines files that appear in a folder."""
    return spark.readStream.schema(ROW).json(path)


def kafka_stream(spark: SparkSession, servers: str, topics: str, mode: str = "earliest-offset", millis: int | None = None) -> DataFrame:
    """The stream of Kafka topics whose values are ROW as JSON, from where the startup mode says."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics)
    if mode == "timestamp":
        reader = reader.option("startingTimestamp", str(millis))
    else:
        reader = reader.option("startingOffsets", "latest" if mode == "latest-offset" else "earliest")
    return reader.load().select(F.from_json(F.col("value").cast("string"), ROW).alias("r")).select("r.*")


__all__ = ["ROW", "Runtime", "Store", "file_stream", "kafka_stream", "start"]
