"""Sources by type: each gives the tables it has, their schemas and their changelogs as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.catalog import Change, Schema, TableId
from deltaloom.operators import changelog
from deltaloom.sinks.formats import SOURCE_DIALECTS
from deltaloom.sources.chunks import CHUNK_ROWS, STARTUP_MODES, predicates, started
from deltaloom.sources.positions import Reshard, Shards, Transactions, by_vector
from deltaloom.sources.probes import chunk_bounds
from deltaloom.sources.segments import Segments
from deltaloom.sources.selectors import Selectors
from deltaloom.streaming.normalize import normalized

SOURCES: dict[str, Callable[[SparkSession, Mapping[str, object]], Source]] = {}


@dataclass
class Source:
    """tables: changelogs by table, each bounded. schemas: theirs. events: schema changes in order, with the place among
    a table's rows (seq) from which they hold. metadata: own metadata columns and their types."""

    tables: dict[TableId, DataFrame]
    schemas: dict[TableId, Schema]
    events: list[tuple[int, Change]] = field(default_factory=list)
    metadata: dict[str, str] = field(default_factory=dict)
    parallel_metadata: bool = False

    def namespaces(self) -> list[str]:
        return sorted({t.namespace for t in self.tables if t.namespace})

    def schema_names(self, namespace: str | None = None) -> list[str]:
        return sorted({t.schema for t in self.tables if t.schema and (namespace is None or t.namespace == namespace)})

    def list_tables(self, namespace: str | None = None, schema: str | None = None) -> list[TableId]:
        return sorted(t for t in self.tables if namespace in (None, t.namespace) and schema in (None, t.schema))


def source(name: str) -> Callable:
    def add(made: Callable) -> Callable:
        SOURCES[name] = made
        return made

    return add


def open_source(spark: SparkSession, options: Mapping[str, object]) -> Source:
    kind = str(options.get("type", ""))
    if kind not in SOURCES:
        raise ValueError(f"no source {kind!r}; one of {', '.join(sorted(SOURCES))}")
    found = SOURCES[kind](spark, options)
    if options.get("tables"):
        keep = Selectors(str(options["tables"]), str(options["tables.exclude"]) if options.get("tables.exclude") else None)
        found.tables = {t: f for t, f in found.tables.items() if keep.matches(t)}
        found.events = [(at, e) for at, e in found.events if keep.matches(e.table)]
    return found


@source("values")
def values(spark: SparkSession, options: Mapping[str, object]) -> Source:
    """Events given in the definition: [{table, schema: [[name, type]], keys, rows: [[op, before, after]]}]."""
    tables, schemas = {}, {}
    for one in options.get("events", []):
        table = TableId.parse(one["table"])
        schema = schemas[table] = Schema.of(*map(tuple, one["schema"]), keys=one.get("keys", []))
        row = T.StructType([T.StructField(f.name, f.dataType) for f in schema.spark()])
        kind = T.StructType([T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row), T.StructField("meta", changelog.META), T.StructField("seq", T.LongType())])
        data = [(op, b and tuple(b), a and tuple(a), None, i) for i, (op, b, a) in enumerate(one["rows"])]
        tables[table] = changelog.validated(spark.createDataFrame(data, kind))
    return Source(tables, schemas)


@source("files")
def files(spark: SparkSession, options: Mapping[str, object]) -> Source:
    """Tables of files: path (a folder of <name>.<format>), format, and keys ({table: [columns]}); rows are inserts."""
    style, root, keys = str(options.get("format", "parquet")), str(options["path"]).rstrip("/"), options.get("keys") or {}
    names = options.get("names") or [t for t in keys]
    tables, schemas = {}, {}
    for name in names:
        table = TableId.parse(name)
        rows = spark.read.format(style).load(f"{root}/{table.table}.{style}")
        tables[table], schemas[table] = changelog.envelope(rows), Schema.from_spark(rows.schema, keys.get(name, []))
    return Source(tables, schemas)


def jdbc_snapshot(spark: SparkSession, options: Mapping[str, object], table: str, key: str | None, bounds: list[tuple] | None = None) -> DataFrame:
    """A table, or its chunks of these bounds, read by one query a chunk of the key. Bounds are probed for in the database
    (see probes); rows without a key are in the chunk that is open below."""
    where = (options.get("scan.snapshot.filters") or {}).get(table)
    source = f"(SELECT * FROM {table} WHERE {where}) t" if where else table
    whole = spark.read.format("jdbc").options(**{k: str(v) for k, v in options.items() if k in ("url", "user", "password", "driver", "fetchsize")}).option("dbtable", source).load()
    if not key:
        return whole
    if bounds is None:
        bounds = chunk_bounds(spark, options, table, key, whole.schema[key].dataType, int(options.get("scan.incremental.snapshot.chunk.size", CHUNK_ROWS)), where)
    props = {k: str(options[k]) for k in ("user", "password", "driver", "fetchsize") if options.get(k)}
    first = str(options.get("scan.incremental.snapshot.unbounded-chunk-first.enabled", "false")).lower() == "true"
    return spark.read.jdbc(str(options["url"]), source, predicates=predicates(bounds, key, first, nulls=True), properties=props)


def column_types(spark: SparkSession, options: Mapping[str, object], table: TableId) -> list[tuple[str, str, bool]]:
    """(name, type as the database writes it, whether it may be NULL) of a table's columns, from the driver's metadata."""
    manager = spark.sparkContext._jvm.java.sql.DriverManager
    connection = manager.getConnection(str(options["url"]), str(options.get("user", "")), str(options.get("password", "")))
    sized = ("DECIMAL", "NUMERIC", "NUMBER", "CHAR", "VARCHAR", "VARCHAR2", "BINARY", "VARBINARY", "BIT", "TIME", "TIMESTAMP", "DATETIME", "DATETIME2", "DATETIMEOFFSET")
    try:
        catalog = table.namespace or (table.schema if "mysql" in str(options["url"]) else None)
        found, out = connection.getMetaData().getColumns(catalog, table.schema, table.table, None), []
        while found.next():
            name, size, digits = found.getString("TYPE_NAME"), found.getInt("COLUMN_SIZE"), found.getInt("DECIMAL_DIGITS")
            root, _, rest = name.partition(" ")
            if root.upper() in sized and "(" not in name:
                args = f"{size}, {digits}" if root.upper() in sized[:3] else str(digits if root.upper() in sized[9:] else size)
                name = f"{root}({args}) {rest}".strip()
            out.append((found.getString("COLUMN_NAME"), name, found.getInt("NULLABLE") != 0))
        return out
    finally:
        connection.close()


def typed_rows(spark: SparkSession, options: Mapping[str, object], table: TableId, rows: DataFrame, dialect: str, keys: list[str]) -> tuple[DataFrame, Schema]:
    """A table's rows and schema in the types that its dialect's columns have here, not those Spark's reader gives them."""
    if dialect not in SOURCE_DIALECTS:
        return rows, Schema.from_spark(rows.schema, keys)
    given = {n: (t, loose) for n, t, loose in column_types(spark, options, table) if n in rows.columns}
    more = {"tinyint1_is_boolean": str(options.get("treat-tinyint1-as-boolean.enabled", "true")).lower() == "true"} if dialect == "mysql" else {}
    kinds = {n: SOURCE_DIALECTS[dialect](t, **more) for n, (t, _) in given.items()}
    columns = [F.col(f"`{f.name}`").cast(kinds[f.name].spark()).alias(f.name) if f.name in kinds else F.col(f"`{f.name}`") for f in rows.schema]
    out = rows.select(*columns)
    plain = Schema.from_spark(out.schema)
    named = [(c.name, str(kinds.get(c.name, c.type)) + ("" if given.get(c.name, ("", True))[1] else " NOT NULL")) for c in plain.columns]
    return out, Schema.of(*named, keys=keys)


def table_names(spark: SparkSession, options: Mapping[str, object]) -> list[str]:
    """The tables that a database source's options name, or that rows of its database do (discover: a query, or a table and a
    column, and a condition)."""
    if options.get("discover"):
        return [str(t) for t in discovered(spark, {**options, "query": None, **options["discover"]}, str(options["discover"].get("column", "")), options["discover"].get("table"), options["discover"].get("where"))]
    return list(options.get("names") or [x for x in str(options.get("tables", "")).split(",") if x])


def database(dialect: str) -> None:
    def made(spark: SparkSession, options: Mapping[str, object]) -> Source:
        """Snapshot by JDBC, log by a change-event stream (see log_events), by the startup mode."""
        mode = str(options.get("scan.startup.mode", "initial"))
        if mode not in STARTUP_MODES:
            raise ValueError(f"no startup mode {mode}; one of {', '.join(STARTUP_MODES)}")
        tables, schemas = {}, {}
        keys = options.get("keys") or {}
        for name in table_names(spark, options):
            table = TableId.parse(name.strip())
            key = (options.get("chunk-key") or {}).get(name) or (keys.get(name) or [None])[0]
            if key is None and not options.get("allow-no-key"):
                raise ValueError(f"{name} has no primary key: give a chunk key")
            rows = jdbc_snapshot(spark, options, str(table), key)
            rows, schemas[table] = typed_rows(spark, options, table, rows, dialect, keys.get(name, []))
            parts = [changelog.envelope(rows, seq=F.lit(-1))] if mode in ("initial", "snapshot") else []
            if options.get("log.path") and mode != "snapshot":
                segments = Segments(spark, str(options["log.path"]))
                offset, millis = options.get("scan.startup.specific-offset.pos", options.get("scan.startup.offset")), options.get("scan.startup.timestamp-millis")
                # of the newest segment what comes after the last position known is still read
                lines = segments.lines(0 if mode == "latest-offset" else segments.start(mode, offset, millis))
                if options.get("scan.startup.specific-offset.gtid-set"):
                    lines = after_transactions(lines, str(options["scan.startup.specific-offset.gtid-set"]))
                log = log_events(lines, table, rows.schema)
                skips = (int(options.get(f"scan.startup.specific-offset.skip-{x}", 0)) for x in ("events", "rows"))
                parts.append(started(log, mode, offset, millis, next(skips), options.get("scan.startup.latest"), next(skips)))
            out = None
            for p in parts:
                out = p if out is None else out.unionByName(p)
            tables[table] = out if out is not None else changelog.envelope(rows).limit(0)
        return Source(tables, schemas, metadata={"op_ts": "BIGINT"})

    SOURCES[dialect] = made


for _name in ("mysql", "postgres", "oracle", "sqlserver", "oceanbase", "db2", "jdbc"):
    database(_name)


def placed_events(spark: SparkSession, options: Mapping[str, object], place: str) -> dict[TableId, tuple[DataFrame, Schema]]:
    """By table the events of a log whose source names a place and a position in it: (op, before, after, meta, place, position).
    names, schemas ({name: [[column, type]]}), keys and log.path."""
    lines, out = spark.read.text(str(options["log.path"])), {}
    for name in options.get("names") or list(options.get("schemas") or {}):
        table, schema = TableId.parse(name), Schema.of(*map(tuple, options["schemas"][name]), keys=(options.get("keys") or {}).get(name, []))
        row = T.StructType([T.StructField(f.name, f.dataType) for f in schema.spark()])
        fields = [("before", row), ("after", row), ("op", T.StringType()), ("ts_ms", T.LongType()), ("source", T.StructType([T.StructField("table", T.StringType()), T.StructField(place, T.StringType()), T.StructField("pos", T.LongType())]))]
        e = lines.select(F.from_json("value", T.StructType([T.StructField(*f) for f in fields])).alias("e")).select("e.*").where(F.col("source.table") == table.table)
        op = F.when(F.col("op").isin("c", "r"), "INSERT").when(F.col("op") == "u", "UPDATE").when(F.col("op") == "d", "DELETE")
        meta = F.create_map(F.lit("op_ts"), F.col("ts_ms").cast("string"))
        out[table] = e.select(op.alias("op"), "before", "after", meta.alias("meta"), F.col(f"source.{place}").alias(place), F.col("source.pos").alias("position")), schema
    return out


@source("vitess")
def vitess(spark: SparkSession, options: Mapping[str, object]) -> Source:
    """A log of shards, each with positions of its own, in whatever order they arrive: since ({shard: position}) is what a reader has,
    reshards ([{ended: {shard: position}, begun: [shard]}]) what became of shards."""
    changes = [Reshard({k: int(v) for k, v in r["ended"].items()}, tuple(r["begun"])) for r in options.get("reshards") or []]
    since, tables, schemas = options.get("since"), {}, {}
    for table, (events, schema) in placed_events(spark, options, "shard").items():
        ordered = by_vector(events, "shard", "position", changes, Shards({k: int(v) for k, v in since.items()}) if since else None)
        tables[table], schemas[table] = ordered.select("op", "before", "after", "meta", "seq"), schema
    return Source(tables, schemas, metadata={"op_ts": "BIGINT"})


@source("tidb")
def tidb(spark: SparkSession, options: Mapping[str, object]) -> Source:
    """A log of regions: changes by their commits' times, up to the time that every region has resolved (lines {region, resolved}); a
    change that came twice counts once. regions is how many there are, by default those that the log names."""
    promised = spark.read.text(str(options["log.path"])).select(F.from_json("value", "region string, resolved bigint, source struct<region: string>").alias("e")).select(F.coalesce("e.region", "e.source.region").alias("region"), "e.resolved")
    by_region = promised.where("region is not null").groupBy("region").agg(F.max("resolved").alias("resolved"))
    least, seen, named = by_region.agg(F.min("resolved"), F.count("resolved"), F.count(F.lit(1))).first()
    least = least if seen >= int(options.get("regions", named)) else None
    tables, schemas = {}, {}
    for table, (events, schema) in placed_events(spark, options, "region").items():
        ready = events.where(F.lit(False) if least is None else F.col("position") <= least)
        once = ready.withColumn("meta", F.map_entries("meta")).distinct().withColumn("meta", F.map_from_entries("meta"))
        tables[table], schemas[table] = once.select("op", "before", "after", "meta", F.col("position").alias("seq")), schema
    return Source(tables, schemas, metadata={"op_ts": "BIGINT"})


@source("mongodb")
def mongodb(spark: SparkSession, options: Mapping[str, object]) -> Source:
    """Collections of documents: names, schemas ({name: [[column, type]]}), snapshot.path (a folder of <name>.json, a document
    a line) and log.path (change-stream events, one a line). _id is the key. A change whose document before isn't in the
    event replaces what stood there, and a deletion then has the key only; scan.full-changelog makes them updates and deletions
    of the document before."""
    mode = str(options.get("scan.startup.mode", "initial"))
    if mode not in STARTUP_MODES:
        raise ValueError(f"no startup mode {mode}; one of {', '.join(STARTUP_MODES)}")
    tables, schemas = {}, {}
    for name in options.get("names") or []:
        table = TableId.parse(name)
        schema = schemas[table] = Schema.of(*map(tuple, (options.get("schemas") or {})[name]), keys=["_id"])
        row = T.StructType([T.StructField(f.name, f.dataType) for f in schema.spark()])
        parts = []
        if options.get("snapshot.path") and mode in ("initial", "snapshot"):
            parts.append(changelog.envelope(spark.read.schema(row).json(f"{str(options['snapshot.path']).rstrip('/')}/{name}.json"), seq=F.lit(-1)))
        if options.get("log.path") and mode != "snapshot":
            parts.append(started(document_events(spark.read.text(str(options["log.path"])), table, row), mode, options.get("scan.startup.offset"), options.get("scan.startup.timestamp-millis")))
        if not parts:
            raise ValueError(f"{name}: give a snapshot.path or a log.path")
        tables[table] = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if str(options.get("scan.full-changelog", "false")).lower() == "true":
            tables[table] = normalized(tables[table], ["_id"])
    return Source(tables, schemas, metadata={"op_ts": "BIGINT"})


def document_events(lines: DataFrame, table: TableId, row: T.StructType, column: str = "value") -> DataFrame:
    """A collection's changes from change-stream events {operationType, ns {db, coll}, documentKey, fullDocument,
    fullDocumentBeforeChange, clusterTime {$timestamp {t, i}}}, in the order of clusterTime."""
    key = T.StructType([f for f in row if f.name == "_id"])
    stamp = T.StructType([T.StructField("$timestamp", T.StructType([T.StructField("t", T.LongType()), T.StructField("i", T.LongType())]))])
    space = T.StructType([T.StructField("db", T.StringType()), T.StructField("coll", T.StringType())])
    fields = [("operationType", T.StringType()), ("ns", space), ("documentKey", key), ("fullDocument", row), ("fullDocumentBeforeChange", row), ("clusterTime", stamp)]
    e = lines.select(F.from_json(F.col(column).cast("string"), T.StructType([T.StructField(*f) for f in fields])).alias("e")).select("e.*")
    e = e.where((F.col("ns.coll") == table.table) & F.col("operationType").isin("insert", "update", "replace", "delete"))
    only_key = F.struct(*[(F.col("documentKey._id") if f.name == "_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in row])
    gone, was = F.col("operationType") == "delete", F.col("fullDocumentBeforeChange").isNotNull()
    op = F.when(gone, "DELETE").when(F.col("operationType") == "insert", "INSERT").when(was, "UPDATE").otherwise("REPLACE")
    before = F.when(gone, F.coalesce("fullDocumentBeforeChange", only_key)).when(F.col("operationType") != "insert", F.col("fullDocumentBeforeChange"))
    at = F.col("clusterTime")["$timestamp"]
    meta = F.create_map(F.lit("op_ts"), (at["t"] * 1000).cast("string"))
    return e.select(op.alias("op"), before.alias("before"), F.when(~gone, F.col("fullDocument")).alias("after"), meta.alias("meta"), (at["t"] * F.lit(1 << 32) + at["i"]).alias("seq"))


def log_events(lines: DataFrame, table: TableId, row: T.StructType, column: str = "value") -> DataFrame:
    """Change events of a table from JSON lines {before, after, op (c, r, u, d), ts_ms, source {db, table, pos}}."""
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in row])
    kind = T.StructType([T.StructField("before", loose), T.StructField("after", loose), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()), T.StructField("source", T.StructType([T.StructField("db", T.StringType()), T.StructField("table", T.StringType()), T.StructField("pos", T.LongType())]))])
    read = lines.select(F.from_json(F.col(column).cast("string"), kind).alias("e")).where(F.col("e.source.table") == table.table)
    op = F.when(F.col("e.op").isin("c", "r"), "INSERT").when(F.col("e.op") == "u", "UPDATE").when(F.col("e.op") == "d", "DELETE")
    return read.select(op.alias("op"), "e.before", "e.after", F.create_map(F.lit("op_ts"), F.col("e.ts_ms").cast("string")).alias("meta"), F.coalesce("e.source.pos", "e.ts_ms").alias("seq"))


def after_transactions(lines: DataFrame, known: str) -> DataFrame:
    """The events of a log (JSON lines whose source.gtid is server:number) that a set of transactions lacks."""
    gtid = F.from_json("value", "source struct<gtid: string>")["source"]["gtid"]
    return lines.where(~Transactions.parse(known).has(F.substring_index(gtid, ":", 1), F.substring_index(gtid, ":", -1).try_cast("bigint")))


def discovered(spark: SparkSession, options: Mapping[str, object], column: str, table: str | None = None, where: str | None = None) -> list[TableId]:
    """Tables named by the rows of a JDBC query; names that aren't tables are left out."""
    query = str(options["query"]) if options.get("query") else f"SELECT {column} FROM {table}" + (f" WHERE {where}" if where else "")
    rows = spark.read.format("jdbc").options(**{k: str(options[k]) for k in ("url", "user", "password", "driver") if options.get(k)}).option("query", query).load()
    out = []
    for (name,) in rows.select(rows.columns[0]).distinct().collect():
        try:
            out.append(TableId.parse(str(name)))
        except ValueError:
            continue
    return sorted(out)


def control_row(change: Change) -> str:
    """A schema change as the payload of a stream's control row."""
    return json.dumps({"table": str(change.table), "kind": change.kind, "added": [[c.name, str(c.type), w, a] for c, w, a in change.added], "types": [[n, str(t)] for n, t in change.types], "dropped": list(change.dropped), "renamed": [list(x) for x in change.renamed], "comment": change.comment, "schema": change.schema and [[c.name, str(c.type)] for c in change.schema.columns], "keys": change.schema and list(change.schema.primary_keys)})


def control_change(text: str) -> Change:
    from deltaloom.catalog import Column as TableColumn
    from deltaloom.catalog import Type

    d = json.loads(text)
    schema = Schema.of(*map(tuple, d["schema"]), keys=d["keys"] or []) if d.get("schema") else None
    return Change(TableId.parse(d["table"]), d["kind"], schema, tuple((TableColumn(n, Type.parse(t)), w, a) for n, t, w, a in d.get("added") or []), tuple((n, Type.parse(t)) for n, t in d.get("types") or []), tuple(d.get("dropped") or []), tuple((a, b) for a, b in d.get("renamed") or []), d.get("comment"))


__all__ = ["SOURCES", "Column", "Source", "control_change", "control_row", "discovered", "jdbc_snapshot", "log_events", "open_source"]
