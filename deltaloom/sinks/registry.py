"""Sinks by type. A sink takes a table's projected changelog; those of primary keys hold the table it leaves."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom import package
from deltaloom.catalog import Change, Schema, TableId
from deltaloom.operators import changelog
from deltaloom.operators.evolve import coerced
from deltaloom.sinks.formats import SINK_DIALECTS, kafka_rows
from deltaloom.sinks.loads import Loads, label_of
from deltaloom.store import Store

SINKS: dict[str, Callable[[SparkSession, Mapping[str, object]], Sink]] = {}


class Sink:
    """write() takes one table's changes of a part of a batch (parts are what schema changes cut a batch into); apply() a
    schema change. What was seen is written again with the same outcome: a stream names itself as the sink's writer, and its
    batches and parts only grow. apply() with again may follow an attempt that was cut short, and does what is missing."""

    #: Schema changes that the sink can apply.
    supported = frozenset({"create.table", "add.column", "alter.column.type", "drop.column", "rename.column", "table.comment", "truncate.table", "drop.table"})
    #: Whether the sink brings its own hash for partitioning.
    own_hash = False
    #: Whether schema changes reach a system that refuses them a second time, so that a stream must note them.
    keeps_schemas = False
    #: The stream that writes, if one does.
    writer: str | None = None
    #: How many tables may be written at a time.
    together = 8
    #: Whether write() only keeps what it is given.
    lazy = False

    def __init__(self, spark: SparkSession, options: Mapping[str, object]) -> None:
        self.spark, self.options = spark, options
        #: What a bounded run has seen of each table (rows by kind, last seq), once it is written.
        self.seen: dict[str, Observation] = {}

    def apply(self, change: Change, again: bool = False) -> None:
        if change.kind not in self.supported:
            raise ValueError(f"the sink can't apply {change.kind}")

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        raise NotImplementedError


def numbered(batch: int, part: int) -> str:
    """The name of a part of a batch."""
    return f"{batch}.{part}" if part else str(batch)


def sink(name: str) -> Callable:
    def add(made: type) -> type:
        SINKS[name] = made
        return made

    return add


def open_sink(spark: SparkSession, options: Mapping[str, object]) -> Sink:
    kind = str(options.get("type", ""))
    if kind not in SINKS:
        raise ValueError(f"no sink {kind!r}; one of {', '.join(sorted(SINKS))}")
    return SINKS[kind](spark, options)


@sink("values")
class Values(Sink):
    """Keeps changelogs as given, in the driver's memory of plans; for tests and shells. materialized() is the table."""

    lazy = True

    def __init__(self, spark: SparkSession, options: Mapping[str, object]) -> None:
        super().__init__(spark, options)
        self.batches: dict[str, dict[tuple[int, int], DataFrame]] = {}
        self.schemas: dict[str, Schema] = {}
        self.events: list[Change] = []

    def apply(self, change: Change, again: bool = False) -> None:
        super().apply(change)
        self.events.append(change)

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        self.batches.setdefault(str(table), {})[batch, part] = changes
        self.schemas[str(table)] = schema

    def changelog(self, table: str) -> DataFrame:
        out = None
        for _, frame in sorted(self.batches[table].items()):
            out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
        return out

    def materialized(self, table: str) -> DataFrame:
        return changelog.materialized(self.changelog(table), self.schemas[table].primary_keys)


@sink("files")
class Files(Sink):
    """A folder for each table. Tables without a key hold appended changes. Of those with one a batch writes only what it
    changes, each key's last state; after compact.batches such folders (8) they are merged into a new version of the table, and what
    it replaces is deleted. read() is the newest version with the later changes on top. A column's new name or end, and a
    table's, are noted beside the folders with the last of these, and hold for all up to it."""

    keeps_schemas = True
    HISTORY = "_history"

    def history(self, table: TableId) -> list[dict]:
        return json.loads(Store(self.spark, self.root(table)).read(self.HISTORY) or "[]")

    def apply(self, change: Change, again: bool = False) -> None:
        super().apply(change)
        if change.kind not in ("rename.column", "drop.column", "drop.table", "truncate.table"):
            return
        known, last = self.history(change.table), max((*self.versions(change.table), *self.folders(change.table, "changes")), default=None)
        note = {"upto": last, "renamed": [list(r) for r in change.renamed], "dropped": list(change.dropped), "cleared": change.kind.endswith("table")}
        if last is not None and not (again and known and known[-1] == json.loads(json.dumps(note))):
            Store(self.spark, self.root(change.table)).write(self.HISTORY, json.dumps([*known, note]))

    def layer(self, table: TableId, kind: str, number: tuple[int, int], history: list[dict]) -> DataFrame:
        """A folder's rows under the names that its columns have now."""
        rows = self.spark.read.parquet(f"{self.root(table)}/{kind}={numbered(*number)}")
        for note in (n for n in history if tuple(n["upto"]) >= number):
            rows = rows.withColumnsRenamed(dict(note["renamed"])).drop(*note["dropped"])
            rows = rows.limit(0) if note["cleared"] else rows
        return rows

    def root(self, table: TableId) -> str:
        return f"{str(self.options['path']).rstrip('/')}/{table}"

    def _path(self, text: str) -> tuple[object, object]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def folders(self, table: TableId, kind: str) -> list[tuple[int, int]]:
        """The (batch, part) of a kind of folder (version or changes) that are written in full."""
        path, fs = self._path(self.root(table))
        found = [x.getPath() for x in fs.listStatus(path)] if fs.exists(path) else []
        whole = [p for p in found if p.getName().startswith(f"{kind}=") and fs.exists(self._path(f"{p}/_SUCCESS")[0])]
        told = [p.getName().partition("=")[2].partition(".") for p in whole]
        return sorted((int(batch), int(part or 0)) for batch, _, part in told)

    def versions(self, table: TableId) -> list[tuple[int, int]]:
        return self.folders(table, "version")

    def pending(self, table: TableId) -> list[tuple[int, int]]:
        """The (batch, part) of changes that the newest version hasn't."""
        last = max(self.versions(table), default=(-1, 0))
        return [b for b in self.folders(table, "changes") if b > last]

    def read(self, table: TableId) -> DataFrame:
        versions, later = self.versions(table), self.pending(table)
        if not versions and not later:
            raise ValueError(f"{table} hasn't been written")
        history = self.history(table)
        if self.options.get("append"):
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [self.layer(table, "version", v, history) for v in versions])
        layers = [self.layer(table, "version", v, history).withColumn("gone_", F.lit(0)) for v in versions[-1:]]
        layers += [self.layer(table, "changes", b, history) for b in later]
        newest = layers[-1].drop("gone_")
        if not later:
            return newest
        target, kind = Schema.from_spark(newest.schema), T.StructType([T.StructField(f.name, f.dataType) for f in newest.schema])
        keys, merged = [f.name for f in newest.schema if f.metadata.get("key")], None
        for place, layer in enumerate(layers):
            own = layer.drop("gone_")
            row = coerced(F.struct(*[F.col(f"`{c}`") for c in own.columns]), Schema.from_spark(own.schema), target).cast(kind)
            layer = layer.select(row.alias("row"), "gone_", F.lit(place).alias("place"))
            merged = layer if merged is None else merged.unionByName(layer)
        last = merged.groupBy(*[F.col(f"row.`{k}`").alias(f"k{i}_") for i, k in enumerate(keys)]).agg(F.max_by(F.struct("row", "gone_"), "place").alias("l"))
        return last.where("l.gone_ = 0").select("l.row.*")

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        number = numbered(batch, part)
        if not schema.primary_keys:
            sides = changelog.exploded(changes.where("op <> 'REPLACE'").unionByName(changes.where("op = 'REPLACE'").withColumn("op", F.lit("INSERT"))))
            sides.write.mode("overwrite").parquet(f"{self.root(table)}/version={number}")
            return
        states(changes, schema).select(*marked_keys(schema.names, schema.primary_keys), "gone_").write.mode("overwrite").parquet(f"{self.root(table)}/changes={number}")
        later = self.pending(table)
        if len(later) >= int(self.options.get("compact.batches", 8)):
            self.compact(table, schema, later[-1])

    def compact(self, table: TableId, schema: Schema, last: tuple[int, int]) -> None:
        """Makes the version of a part of a batch, and deletes the folders that it stands for."""
        parts = list(schema.partition_keys)
        rows = self.read(table)
        rows = rows.select(*marked_keys(rows.columns, schema.primary_keys))
        before = [("version", v) for v in self.versions(table) if v < last] + [("changes", b) for b in self.folders(table, "changes") if b <= last]
        (rows.repartition(*parts) if parts else rows).write.mode("overwrite").partitionBy(*parts).parquet(f"{self.root(table)}/version={numbered(*last)}")
        for kind, old in before:
            path, fs = self._path(f"{self.root(table)}/{kind}={numbered(*old)}")
            fs.delete(path, True)


def marked_keys(names: Sequence[str], keys: Sequence[str]) -> list[Column]:
    """Columns whose files will tell which of them are keys."""
    return [F.col(f"`{c}`").alias(c, metadata={"key": True}) if c in keys else F.col(f"`{c}`") for c in names]


@sink("kafka")
class Kafka(Sink):
    """Messages to topics, or to JSON-lines files under path where there is no broker."""

    own_hash = True

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        mapping = dict(x.split(":", 1) for x in str(self.options.get("sink.tableId-to-topic.mapping", "")).split(";") if ":" in x)
        rows = kafka_rows(
            changes, table, schema.primary_keys, str(self.options.get("value.format", "debezium-json")), str(self.options.get("key.format", "json")), self.options.get("topic"), mapping,
            str(self.options.get("partition.strategy", "all-to-zero")), str(self.options.get("sink.add-tableId-to-header-enabled", "false")).lower() == "true",
        )
        if self.options.get("path"):
            rows.write.mode("overwrite").json(f"{str(self.options['path']).rstrip('/')}/{table}/batch={numbered(batch, part)}")
        else:
            rows.write.format("kafka").option("kafka.bootstrap.servers", str(self.options["properties.bootstrap.servers"])).save()


class Database(Sink):
    """Upserts and deletions by JDBC: each key's last state goes to a staging table, from which one transaction deletes and
    inserts, and notes in a ledger how far the writing stream is with the table. A part that comes again is known by the
    ledger and left out, so tables without a key, too, get its rows once."""

    dialect, mark, keeps_schemas = "jdbc", '"', True
    #: (writer, target, batch, part): the last part that a stream has written to a table.
    LEDGER = "deltaloom_ledger"

    @property
    def together(self) -> int:
        return int(self.options.get("sink.parallel.tables", 1))

    def quoted(self, name: object) -> str:
        """A name, or a table's parts, in the dialect's marks."""
        return ".".join(f"{self.mark}{part.replace(self.mark, 2 * self.mark)}{self.mark}" for part in (name.parts if isinstance(name, TableId) else [str(name)]))

    def ddl(self, table: TableId, schema: Schema) -> str:
        kind, q = SINK_DIALECTS.get(self.dialect, lambda t: str(t.optional())), self.quoted
        columns = ", ".join(f"{q(c.name)} {kind(c.type)}{'' if c.type.nullable else ' NOT NULL'}" for c in schema.columns)
        keys = f", PRIMARY KEY ({', '.join(map(q, schema.primary_keys))})" if schema.primary_keys else ""
        return f"CREATE TABLE {'' if self.dialect == 'jdbc' else 'IF NOT EXISTS '}{q(table)} ({columns}{keys})"

    def statements(self, change: Change) -> list[str]:
        """The DDL of a schema change."""
        kind, q = SINK_DIALECTS.get(self.dialect, lambda t: str(t.optional())), self.quoted
        table = q(change.table)
        if change.kind == "create.table":
            return [self.ddl(change.table, change.schema)]
        if change.kind == "add.column":
            place = lambda w, a: {"FIRST": " FIRST", "AFTER": f" AFTER {q(a)}"}.get(w, "")
            return [f"ALTER TABLE {table} ADD COLUMN {q(c.name)} {kind(c.type)}{place(w, a)}" for c, w, a in change.added]
        if change.kind == "alter.column.type":
            return [f"ALTER TABLE {table} MODIFY COLUMN {q(n)} {kind(t)}" for n, t in change.types]
        if change.kind == "drop.column":
            return [f"ALTER TABLE {table} DROP COLUMN {q(n)}" for n in change.dropped]
        if change.kind == "rename.column":
            return [f"ALTER TABLE {table} RENAME COLUMN {q(a)} TO {q(b)}" for a, b in change.renamed]
        if change.kind == "table.comment":
            text = str(change.comment or "").replace("'", "''")
            return [f"COMMENT ON TABLE {table} IS '{text}'" if self.mark == '"' else f"ALTER TABLE {table} COMMENT = '{text}'"]
        return {"drop.table": [f"DROP TABLE {'' if self.dialect == 'jdbc' else 'IF EXISTS '}{table}"], "truncate.table": [f"TRUNCATE TABLE {table}"]}[change.kind]

    def apply(self, change: Change, again: bool = False) -> None:
        super().apply(change)
        if not self.options.get("url"):  # loads only: tables are made elsewhere
            return
        if change.kind == "create.table" and self.columns(change.table):
            return
        if again and (change := self.missing(change)) is None:
            return
        for text in self.statements(change):
            self.execute(text)

    def missing(self, change: Change) -> Change | None:
        """What of a change the database doesn't have yet, by its own catalog; changes of types and comments can be repeated."""
        own = set(self.columns(change.table))
        if change.kind == "add.column":
            change = replace(change, added=tuple(a for a in change.added if a[0].name not in own))
        elif change.kind == "drop.column":
            change = replace(change, dropped=tuple(n for n in change.dropped if n in own))
        elif change.kind == "rename.column":
            change = replace(change, renamed=tuple((a, b) for a, b in change.renamed if a in own))
        elif change.kind in ("drop.table", "truncate.table"):
            return change if own else None
        return None if change.kind in ("add.column", "drop.column", "rename.column") and not (change.added or change.dropped or change.renamed) else change

    def connection(self) -> object:
        return self.spark.sparkContext._jvm.java.sql.DriverManager.getConnection(str(self.options["url"]), str(self.options.get("user", "")), str(self.options.get("password", "")))

    def columns(self, table: TableId) -> list[str]:
        """A table's columns, none if there is no such table."""
        connection = self.connection()
        try:
            catalog, schema = (table.namespace or table.schema, None) if self.mark == "`" else (table.namespace, table.schema)
            found, out = connection.getMetaData().getColumns(catalog, schema, table.table, None), []
            while found.next():
                out.append(found.getString("COLUMN_NAME"))
            return out
        finally:
            connection.close()

    def execute(self, *texts: str) -> None:
        """Statements in one transaction."""
        connection = self.connection()
        try:
            connection.setAutoCommit(False)
            for text in texts:
                connection.createStatement().execute(text)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def reached(self, table: TableId) -> tuple[int, int]:
        """The last (batch, part) that the writer has written to a table."""
        ledger = TableId.parse(self.LEDGER)
        if not self.columns(ledger):
            texts = ", ".join(f"{self.quoted(c)} VARCHAR(500) NOT NULL" for c in ("writer", "target"))
            numbers = ", ".join(f"{self.quoted(c)} BIGINT" for c in ("batch", "part"))
            self.execute(f"CREATE TABLE {self.quoted(ledger)} ({texts}, {numbers}, PRIMARY KEY ({self.quoted('writer')}, {self.quoted('target')}))")
        connection = self.connection()
        try:
            found = connection.createStatement().executeQuery(f"SELECT {self.quoted('batch')}, {self.quoted('part')} FROM {self.quoted(ledger)} WHERE {self.own(table)}")
            return (found.getLong(1), found.getLong(2)) if found.next() else (-1, -1)
        finally:
            connection.close()

    def own(self, table: TableId) -> str:
        """The ledger's row of the writer and a table, as a predicate."""
        return " AND ".join(f"{self.quoted(c)} = {text_of(v)}" for c, v in (("writer", self.writer), ("target", table)))

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        if self.options.get("load.url"):
            self.load(table, changes, schema, batch, part)
            return
        if self.writer and self.reached(table) >= (batch, part):
            return
        q, keys = self.quoted, list(schema.primary_keys)
        name, stage, ledger = q(table), q(TableId.parse(f"{table}_stage")), q(TableId.parse(self.LEDGER))
        rows = states(changes, schema) if keys else changes.where("after is not null").select("after.*", F.lit(0).alias("gone_"))
        rows.write.format("jdbc").options(url=str(self.options["url"]), dbtable=stage, user=str(self.options.get("user", "")), password=str(self.options.get("password", ""))).mode("overwrite").save()
        names = ", ".join(map(q, schema.names))
        work = [f"DELETE FROM {name} WHERE EXISTS (SELECT 1 FROM {stage} s WHERE {' AND '.join(f's.{q(k)} = {name}.{q(k)}' for k in keys)})"] if keys else []
        work.append(f"INSERT INTO {name} ({names}) SELECT {names} FROM {stage} WHERE {q('gone_')} = 0")
        if self.writer:
            work += [f"DELETE FROM {ledger} WHERE {self.own(table)}", f"INSERT INTO {ledger} VALUES ({text_of(self.writer)}, {text_of(table)}, {batch}, {part})"]
        self.execute(*work)
        with contextlib.suppress(Exception):  # the part is written; the next one overwrites the stage
            self.execute(f"DROP TABLE {stage}")


    def load(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int) -> None:
        """By HTTP (see loads): each key's last state with a mark of deletions, or, without a key, the rows after."""
        mark = {"doris": "__DORIS_DELETE_SIGN__", "starrocks": "__op"}[self.dialect]
        rows = states(changes, schema) if schema.primary_keys else changes.where("after is not null").select("after.*", F.lit(0).alias("gone_"))
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in schema.names], F.col("gone_").alias(mark)), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
        lines = rows.select(line.alias("value"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(schema.primary_keys)])
        loaded(self, lines, self.dialect, {"database": str(table.schema or table.namespace), "table": table.table}, label_of(self.writer or uuid.uuid4().hex, table, batch, part))


def loaded(sink: Sink, lines: DataFrame, kind: str, options: Mapping[str, str], label: str) -> None:
    """Lines (value, and columns to deal them by) in as many shares as sink.parallelism says (8); a share that comes again has the
    same lines, as its label wants."""
    package.ship(sink.spark)
    sink.spark.dataSource.register(Loads)
    shares, by = int(sink.options.get("sink.parallelism", 8)), [c for c in lines.columns if c != "value"] or ["value"]
    given = {k: str(sink.options[o]) for k, o in (("url", "load.url"), ("user", "user"), ("password", "password"), ("bytes", "sink.buffer-flush.max-bytes")) if sink.options.get(o)}
    lines.repartition(shares, *by).sortWithinPartitions("value").select("value").write.format("deltaloom-load").mode("append").options(kind=kind, label=f"{label}-{shares}", **given, **options).save()


def text_of(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def states(changes: DataFrame, schema: Schema) -> DataFrame:
    """The schema's columns and gone_ (0 or 1) for each key that changes touch: its last row, or just the key if it is gone."""
    keys = schema.primary_keys
    value = lambda c: F.coalesce(F.col(f"row.`{c}`"), F.col(f"key.`{c}`")) if c in keys else F.col(f"row.`{c}`")
    return changelog.last_effects(changes, keys).select(*[value(c).alias(c) for c in schema.names], F.col("row").isNull().cast("int").alias("gone_"))


for _name, _mark in (("jdbc", '"'), ("doris", "`"), ("starrocks", "`"), ("oceanbase", "`"), ("maxcompute", "`")):
    SINKS[_name] = type(_name.title(), (Database,), {"dialect": _name, "mark": _mark})


class Catalogued(Sink):
    """Tables of a catalog that has row-level MERGE: upserts and deletions in one MERGE of each key's last change."""

    keeps_schemas = True

    def dealt(self, table: TableId, rows: DataFrame, schema: Schema) -> DataFrame:
        """rows as the sink wants them in tasks."""
        return rows

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        keys = list(schema.primary_keys)
        name = ".".join([str(self.options["catalog"]), *table.parts]) if self.options.get("catalog") else str(table)
        if not keys:
            changes.where("after is not null").select("after.*").writeTo(name).append()
            return
        rows = self.dealt(table, states(changes, schema), schema).alias("s")
        on = F.lit(True)
        for k in keys:
            on = on & (F.col(f"{name}.{k}") == F.col(f"s.{k}"))
        values = {c: F.col(f"s.{c}") for c in schema.names}
        rows.mergeInto(name, on).whenMatched(F.col("s.gone_") == 1).delete().whenMatched().update(values).whenNotMatched(F.col("s.gone_") == 0).insert(values).merge()

    def apply(self, change: Change, again: bool = False) -> None:
        super().apply(change)
        name = ".".join([str(self.options["catalog"]), *change.table.parts]) if self.options.get("catalog") else str(change.table)
        if change.kind == "create.table":
            parts = f" PARTITIONED BY ({', '.join(change.schema.partition_keys)})" if change.schema.partition_keys else ""
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in change.schema.spark())
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING {self.options.get('format', 'iceberg')}{parts}")
        elif change.kind == "add.column":
            own = self.spark.table(name).columns if again else []
            for c, w, a in (x for x in change.added if x[0].name not in own):
                place = " FIRST" if w == "FIRST" else f" AFTER `{a}`" if w == "AFTER" else ""
                self.spark.sql(f"ALTER TABLE {name} ADD COLUMN `{c.name}` {c.type.spark().simpleString()}{place}")
        elif change.kind == "alter.column.type":
            for n, t in change.types:
                self.spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{n}` TYPE {t.spark().simpleString()}")
        elif change.kind == "drop.column":
            self.spark.sql(f"ALTER TABLE {name} DROP COLUMNS {'IF EXISTS ' if again else ''}({', '.join(f'`{n}`' for n in change.dropped)})")
        elif change.kind == "rename.column":
            own = self.spark.table(name).columns if again else None
            for a, b in (x for x in change.renamed if own is None or x[0] in own):
                self.spark.sql(f"ALTER TABLE {name} RENAME COLUMN `{a}` TO `{b}`")
        elif change.kind == "table.comment":
            self.spark.sql(f"COMMENT ON TABLE {name} IS '" + str(change.comment or "").replace("'", "\\'") + "'")
        elif change.kind in ("drop.table", "truncate.table"):
            self.spark.sql(f"{'DROP TABLE IF EXISTS' if change.kind == 'drop.table' else 'TRUNCATE TABLE'} {name}")


for _name in ("iceberg", "paimon", "hudi"):
    SINKS[_name] = type(_name.title(), (Catalogued,), {})


def by_table(text: object) -> dict[str, str]:
    """Options of the form table:value;table:value."""
    return {t.strip(): v.strip() for t, _, v in (x.partition(":") for x in str(text or "").split(";")) if t.strip()}


@sink("fluss")
class Fluss(Catalogued):
    """Tables in buckets: rows go to tasks by the bucket they lie in, so a bucket has one writer and a writer whole buckets.

    bucket.key (table:key,key;...) must be of a table's primary key without its partition keys, which is what is taken where it
    isn't given; rows of a table without a key are dealt at random. bucket.num is table:number;..."""

    own_hash = True

    def bucket_keys(self, table: TableId, schema: Schema) -> list[str]:
        allowed = [k for k in schema.primary_keys if k not in schema.partition_keys]
        given = [k.strip() for k in by_table(self.options.get("bucket.key")).get(str(table), "").split(",") if k.strip()]
        if given and schema.primary_keys and not set(given) <= set(allowed):
            raise ValueError(f"bucket keys {given} of {table} must be of {allowed}")
        return given or allowed

    def dealt(self, table: TableId, rows: DataFrame, schema: Schema) -> DataFrame:
        """rows with bucket, each in the task of its bucket's number."""
        count, keys = int(by_table(self.options.get("bucket.num")).get(str(table), 1)), self.bucket_keys(table, schema)
        number = F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(count)) if keys else F.floor(F.rand() * count).cast("int")
        return rows.withColumn("bucket", number).repartitionById(count, F.col("bucket"))


@sink("elasticsearch")
class Elasticsearch(Sink):
    """Bulk lines (an action, then its document), sent to load.url or as text files, a folder for each batch: one action for each
    key's last state. The index may have a shard suffix from a column, of a deletion's key only if that column is part of it."""

    def write(self, table: TableId, changes: DataFrame, schema: Schema, batch: int, part: int = 0) -> None:
        suffix = dict(x.split(":", 1) for x in str(self.options.get("sharding.suffix.key", "")).split(";") if ":" in x).get(str(table))
        index = F.concat_ws(str(self.options.get("sharding.suffix.separator", "$")), F.lit(str(self.options.get("index") or table)), *([F.col(f"`{suffix}`").cast("string")] if suffix else []))
        key = F.concat_ws("_", *[F.col(f"`{k}`").cast("string") for k in schema.primary_keys])
        head = F.struct(index.alias("_index"), key.alias("_id"))
        gone = F.col("gone_") == 1
        action = F.when(gone, F.to_json(F.struct(head.alias("delete")))).otherwise(F.to_json(F.struct(head.alias("index"))))
        as_text = lambda c: SINK_DIALECTS["elasticsearch"](c.type) == "STRING" and c.type.root not in ("MAP", "ROW")
        text = F.struct(*[(F.col(f"`{c.name}`").cast("string") if as_text(c) else F.col(f"`{c.name}`")).alias(c.name) for c in schema.columns])
        lines = F.when(gone, action).otherwise(F.concat_ws("\n", action, F.to_json(text)))
        if self.options.get("load.url"):
            # a document's version is the batch's place, so it can come again, and an older one can't come after
            head = F.struct(index.alias("_index"), key.alias("_id"), F.lit(batch * (1 << 20) + part + 1).cast("bigint").alias("version"), F.lit("external_gte").alias("version_type"))
            action = F.when(gone, F.to_json(F.struct(head.alias("delete")))).otherwise(F.to_json(F.struct(head.alias("index"))))
            sent = F.when(gone, action).otherwise(F.concat_ws("\n", action, F.to_json(text)))
            loaded(self, states(changes, schema).select(sent.alias("value"), key.alias("k0")), "elasticsearch", {}, label_of(self.writer or "bulk", table, batch, part))
            return
        states(changes, schema).select(lines.alias("value")).write.mode("overwrite").text(f"{str(self.options['path']).rstrip('/')}/{table}/batch={numbered(batch, part)}")
