"""Snapshots that become streams: probes, NULL keys, runs that are killed, tables that come later, sinks' ledgers and journals."""

import datetime as dt
import json
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from deltaloom.__main__ import main
from deltaloom.catalog import Change, Column, Schema, TableId, Type
from deltaloom.operators.changelog import materialized
from deltaloom.plans.definition import parse
from deltaloom.sinks.registry import Database, Files, open_sink
from deltaloom.sources import chunks, positions
from deltaloom.sources.follow import Follower, TableOfDatabase, TableOfFiles, WorkReader, follow
from deltaloom.sources.positions import Transactions
from deltaloom.sources.probes import Probes, chunk_bounds
from deltaloom.sources.registry import control_row, jdbc_snapshot, open_source
from deltaloom.sources.segments import Segments
from deltaloom.streaming.normalize import ROCKSDB, normalized
from deltaloom.streaming.resolved import Resolver
from deltaloom.streaming.runtime import ROW, Runtime

ITEMS = TableId.parse("app.items")


def derby(spark, tmp_path, *texts):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    sink = open_sink(spark, {"type": "jdbc", "url": url})
    sink.execute(*texts)
    return url, sink


def values(count, key=lambda i: i):
    return ", ".join(f"({key(i)}, {i})" for i in range(count))


def test_rows_without_a_key_are_in_the_first_chunk(spark, tmp_path):
    url, _ = derby(spark, tmp_path, "CREATE TABLE T (K VARCHAR(9), V INT)", "CREATE TABLE E (K VARCHAR(9), V INT)", f"INSERT INTO T VALUES {values(20, lambda i: 'NULL' if i % 4 == 0 else repr(f'k{i:02}'))}", "INSERT INTO E VALUES (NULL, 1), (NULL, 2)")
    options = {"url": url, "scan.incremental.snapshot.chunk.size": 4}
    assert sorted(r["V"] for r in jdbc_snapshot(spark, options, "T", "K").collect()) == list(range(20))
    assert jdbc_snapshot(spark, options, "T", "K").rdd.getNumPartitions() == 4
    assert sorted(r["V"] for r in jdbc_snapshot(spark, options, "E", "K").collect()) == [1, 2]
    assert chunks.predicates([(None, 5), (5, None)], "k", nulls=True) == ["k < 5 OR k IS NULL", "k >= 5"]


def test_probes_are_seeks_and_give_the_chunks_of_a_whole_pass(spark, tmp_path):
    url, _ = derby(spark, tmp_path, "CREATE TABLE T (K VARCHAR(9) NOT NULL PRIMARY KEY, V INT)", f"INSERT INTO T VALUES {values(1000, lambda i: repr(f'k{i:04}'))}", "CREATE TABLE D (K INT, V INT)", f"INSERT INTO D VALUES {values(40, lambda i: 7 if i < 30 else i * 100_000)}")
    rows = spark.read.format("jdbc").options(url=url, dbtable="T").load()
    want = [(r["low"], r["high"]) for r in chunks.uneven_chunks(rows, "K", 90).orderBy("chunk_id").collect()]
    assert chunk_bounds(spark, {"url": url}, "T", "K", rows.schema["K"].dataType, 90) == want
    with Probes(spark, {"url": url}) as probes:
        statement = probes.connection.createStatement()
        statement.execute("CALL SYSCS_UTIL.SYSCS_SET_RUNTIMESTATISTICS(1)")
        list(probes.bounds("T", "K", 90))
        told = statement.executeQuery("VALUES SYSCS_UTIL.SYSCS_GET_RUNTIMESTATISTICS()")
        told.next()
        text = told.getString(1)
    assert "Index Scan ResultSet" in text and "Table Scan ResultSet" not in text
    visited = [int(x.split("=")[1]) for x in text.split("\n") if "Number of rows visited" in x]
    assert visited and max(visited) <= 92
    bounds = chunk_bounds(spark, {"url": url}, "D", "K", spark.read.format("jdbc").options(url=url, dbtable="D").load().schema["K"].dataType, 4)
    assert bounds[0][0] is None and bounds[-1][1] is None and bounds[0][1] == 3_000_000  # thirty rows of one key are one chunk
    assert chunk_bounds(spark, {"url": url}, "T", "V", rows.schema["V"].dataType, 100)[:2] == [(None, 100), (100, 200)]


def row(i, name):
    return {"id": i, "name": name}


def event(op, pos, before, after, table="items"):
    return {"op": op, "before": before, "after": after, "ts_ms": pos, "source": {"table": table, "pos": pos}}


def segment(tmp_path, n, *events):
    (tmp_path / "log").mkdir(exist_ok=True)
    (tmp_path / "log" / f"{n:04}.json").write_text("\n".join(map(json.dumps, events)))


class Killed(Exception):
    pass


class Dead(BaseException):
    """What no handler of failures sees, like a killed process."""


class Fragile(Files):
    """Fails once, before or after the nth write."""

    left, after = -1, False

    def write(self, table, changes, schema, batch, part=0):
        self.left -= 1
        if self.left == 0 and not self.after:
            raise Killed
        super().write(table, changes, schema, batch, part)
        if self.left == 0:
            raise Killed


def definition(kind="files", behavior="EVOLVE", more=""):
    return parse(f"source: {{type: values}}\nsink: {{type: {kind}}}\n{more}\npipeline: {{name: follow, schema.change.behavior: {behavior}}}")


def followed(spark, tmp_path, sink, tables, size=10, **options):
    """Runs the stream until it is done or fails; says which."""
    made = Follower(spark, Runtime(spark, definition(), sink, f"{tmp_path}/cp"), f"{tmp_path}/state", f"{tmp_path}/log", size)
    made.begin()
    for first, (table, reader) in enumerate(tables):
        made.add(table, reader, first=not first)
    running = follow(made, f"{tmp_path}/cp", interval="0 seconds", **options)
    try:
        running.processAllAvailable()
        return made
    except Exception:  # noqa: BLE001  the stream's own
        return None
    finally:
        running.stop()


@pytest.mark.parametrize(("n", "after"), [(1, False), (2, True), (4, False), (5, True)])
def test_a_killed_run_resumes_between_chunks_and_in_the_log(spark, tmp_path, n, after):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(60)], "id bigint, name string")
    # 5 is removed and comes again; 61 moves over all chunks; 3 moves to a new key
    segment(tmp_path, 0, event("u", 1, row(5, "n5"), row(5, "x")), event("c", 2, None, row(61, "new")), event("d", 3, row(7, "n7"), None))
    segment(tmp_path, 1, event("d", 4, row(5, "x"), None), event("u", 5, row(61, "new"), row(-4, "new")), event("u", 6, row(3, "n3"), row(70, "n3")))
    segment(tmp_path, 2, event("c", 7, None, row(5, "again")))
    sink = Fragile(spark, {"path": f"{tmp_path}/sink"})
    sink.left, sink.after = n, after
    reader = TableOfFiles(rows, "id", ["id"])
    assert followed(spark, tmp_path, sink, [(ITEMS, reader)], chunks_per_batch=2, segments_per_batch=1) is None
    sink.left = -1
    made = followed(spark, tmp_path, sink, [(ITEMS, reader)], chunks_per_batch=2, segments_per_batch=1)
    assert made.phases() == {"app.items": "following"}
    want = {i: f"n{i}" for i in range(60)} | {5: "again", -4: "new", 70: "n3"}
    del want[7], want[3]
    assert {r["id"]: r["name"] for r in sink.read(ITEMS).collect()} == want


def test_a_table_that_comes_later_is_read_in_full_beside_the_log(spark, tmp_path):
    names, more = TableId.parse("app.names"), spark.createDataFrame([(i, f"m{i}") for i in range(30)], "id bigint, name string")
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id bigint, name string")
    segment(tmp_path, 0, event("u", 1, row(5, "n5"), row(5, "x")), event("u", 2, row(9, "m9"), row(9, "y"), "names"))
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    counted = []
    write = sink.write
    sink.write = lambda table, changes, *rest: (counted.append((str(table), changes.count())), write(table, changes, *rest))
    first = followed(spark, tmp_path, sink, [(ITEMS, TableOfFiles(rows, "id", ["id"]))])
    assert first.phases() == {"app.items": "following"} and sum(n for _, n in counted) == 21
    segment(tmp_path, 1, event("d", 3, row(6, "n6"), None), event("d", 4, row(1, "m1"), None, "names"), event("u", 5, row(0, "m0"), row(40, "m0"), "names"))
    segment(tmp_path, 2, event("u", 6, row(40, "m0"), row(40, "z"), "names"))
    made = followed(spark, tmp_path, sink, [(ITEMS, TableOfFiles(rows, "id", ["id"])), (names, TableOfFiles(more, "id", ["id"]))], chunks_per_batch=1, segments_per_batch=1)
    assert made.phases() == {"app.items": "following", "app.names": "following"}
    assert {r["id"]: r["name"] for r in sink.read(ITEMS).collect()} == {i: f"n{i}" for i in range(20) if i != 6} | {5: "x"}
    assert {r["id"]: r["name"] for r in sink.read(names).collect()} == {i: f"m{i}" for i in range(2, 30)} | {9: "y", 40: "z"}
    assert sum(n for t, n in counted if t == "app.items") == 22  # nothing of the older table came twice


def test_a_table_joins_while_the_stream_runs(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id bigint, name string")
    segment(tmp_path, 0, event("u", 1, row(5, "n5"), row(5, "x")))
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    made = Follower(spark, Runtime(spark, definition(), sink, f"{tmp_path}/cp"), f"{tmp_path}/state", f"{tmp_path}/log", 10)
    made.begin()
    made.add(ITEMS, TableOfFiles(rows, "id", ["id"]), first=True)
    running = follow(made, f"{tmp_path}/cp", interval="0 seconds")
    try:
        running.processAllAvailable()
        made.add(TableId.parse("app.names"), TableOfFiles(rows, "id", ["id"]))
        running.processAllAvailable()
    finally:
        running.stop()
    assert made.phases() == {"app.items": "following", "app.names": "following"} and sink.read(TableId.parse("app.names")).count() == 20


def test_a_database_is_read_in_chunks_and_followed(spark, tmp_path):
    url, source = derby(spark, tmp_path, "CREATE TABLE APP.ITEMS (ID BIGINT NOT NULL PRIMARY KEY, NAME VARCHAR(20))", f"INSERT INTO APP.ITEMS VALUES {', '.join(f'({i}, {chr(39)}n{i}{chr(39)})' for i in range(50))}")
    table = TableId.parse("APP.ITEMS")
    up = lambda i, name: {"ID": i, "NAME": name}
    # the database shows what the log tells before it is read, so an event may be seen twice
    source.execute("UPDATE APP.ITEMS SET NAME = 'x' WHERE ID = 5", "DELETE FROM APP.ITEMS WHERE ID = 6")
    segment(tmp_path, 0, event("u", 1, up(5, "n5"), up(5, "x"), "ITEMS"), event("d", 2, up(6, "n6"), None, "ITEMS"), {"ddl": control_row(Change(table, "add.column", added=((Column("QTY", Type("INT")), "LAST", None),))), "source": {"table": "ITEMS", "pos": 3}}, event("c", 4, None, up(99, "q") | {"QTY": 3}, "ITEMS"))
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    reader = TableOfDatabase(spark, table, {"url": url}, "ID", ["ID"], "postgres")
    made = followed(spark, tmp_path, sink, [(table, reader)], size=8, chunks_per_batch=3)
    assert len(made.bounds("APP.ITEMS")) == 7
    want = {i: (f"n{i}", None) for i in range(50) if i != 6} | {5: ("x", None), 99: ("q", 3)}
    assert {r["ID"]: (r["NAME"], r["QTY"]) for r in sink.read(table).collect()} == want


def test_startup_opens_only_the_segments_that_it_needs(spark, tmp_path):
    for n in range(64):
        segment(tmp_path, n, *([event("c", 10 * n + i, None, row(10 * n + i, "x")) for i in range(10)] if n % 9 else []))
    found = Segments(spark, f"{tmp_path}/log")
    assert found.at_position(355) == 35 and len(found.looked) <= 9
    assert found.lines(found.at_position(355)).inputFiles() != [] and len(found.lines(35).inputFiles()) == 29
    assert [found.at_position(x) for x in (0, 10, 11, 9999)] == [0, 0, 1, 62] and found.at_time(100) == 8
    assert [found.start(m) for m in ("earliest-offset", "latest-offset")] == [0, 64]
    options = {"type": "mysql", "url": derby(spark, tmp_path, "CREATE TABLE APP.ITEMS (ID INT NOT NULL PRIMARY KEY, NAME VARCHAR(9))")[0], "names": ["APP.ITEMS"], "keys": {"APP.ITEMS": ["ID"]}, "log.path": f"{tmp_path}/log"}
    segment(tmp_path, 63, *[event("c", 630 + i, None, {"ID": i, "NAME": "y"}, "ITEMS") | {"source": {"table": "ITEMS", "pos": 630 + i, "gtid": f"S:{i}"}} for i in range(10)])
    rows = open_source(spark, options | {"scan.startup.mode": "specific-offset", "scan.startup.offset": 637}).tables[TableId.parse("APP.ITEMS")]
    assert sorted(r["after"]["ID"] for r in rows.collect()) == [7, 8, 9] and len(rows.inputFiles()) == 1
    rows = open_source(spark, options | {"scan.startup.mode": "earliest-offset", "scan.startup.specific-offset.gtid-set": "s:0-3:9"}).tables[TableId.parse("APP.ITEMS")]
    assert sorted(r["after"]["ID"] for r in rows.collect()) == [4, 5, 6, 7, 8]


def test_a_stream_that_starts_in_the_middle_of_its_log(spark, tmp_path):
    for n in range(6):
        segment(tmp_path, n, *[event("c", 10 * n + i, None, row(10 * n + i, "x")) for i in range(10)])
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    made = Follower(spark, Runtime(spark, definition(), sink, f"{tmp_path}/cp"), f"{tmp_path}/state", f"{tmp_path}/log")
    made.begin("specific-offset", offset=34)
    made.add(ITEMS, TableOfFiles(spark.createDataFrame([], "id bigint, name string"), "id", ["id"]), snapshot=False)
    running = follow(made, f"{tmp_path}/cp", interval="0 seconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    assert sorted(r["id"] for r in sink.read(ITEMS).collect()) == list(range(34, 60))


def test_sets_of_transactions():
    parse = Transactions.parse
    a, b = parse("u:1-5:7:8,V:3"), parse("u:4-9,w:1")
    assert str(a) == "u:1-5:7-8,v:3" and str(a.union(b)) == "u:1-9,v:3,w:1"
    assert str(a.minus(b)) == "u:1-3,v:3" and str(b.minus(a)) == "u:6:9,w:1" and str(a.minus(a)) == ""
    assert a.union(b).contains(a) and not a.contains(b) and a.contains(parse(""))
    for wrong in ("u", "u:x", "u:1-y"):
        with pytest.raises(ValueError):
            parse(wrong)


def test_transactions_over_ranges_of_numbers(spark, monkeypatch):
    monkeypatch.setattr(positions, "RANGE", 10)
    own = [*range(5, 45), *range(50, 51), *range(60, 80), 99, 99]
    log = spark.createDataFrame([("A", i) for i in own] + [("b", 7), (None, 1), ("b", None)], "s string, n bigint")
    have = positions.transactions_of(log, "s", "n")
    assert str(have) == "a:5-44:50:60-79:99,b:7"
    assert positions.to_come(log, Transactions.parse("a:1-98"), "s", "n").count() == 5


def test_vectors_over_shards():
    at = positions.Shards({"-80": 5, "80-": 3})
    assert at.merged(positions.Shards({"80-": 9})).positions == {"-80": 5, "80-": 9}
    split = positions.Reshard({"-80": 6}, ("-40", "40-80"))
    with pytest.raises(ValueError):
        at.resharded(split)
    assert at.merged(positions.Shards({"-80": 6})).resharded(split).positions == {"80-": 3, "-40": 0, "40-80": 0}
    assert positions.generations([split, positions.Reshard({"-40": 2, "40-80": 3}, ("-80",))]) == {"-40": 1, "40-80": 1, "-80": 2}


def test_regions_wait_for_the_slowest_and_batches_repeat(spark, tmp_path):
    out, kind = {}, "region bigint, commit bigint, resolved bigint, v string"
    made = Resolver(spark, str(tmp_path), 2, lambda changes, batch: out.update({batch: [(r["commit"], r["v"]) for r in changes.collect()]}))
    made.batch(spark.createDataFrame([(0, 5, None, "a"), (1, 2, None, "b"), (0, None, 9, None)], kind), 0)
    assert out[0] == []  # the other region has promised nothing
    second = spark.createDataFrame([(1, 7, None, "c"), (1, None, 6, None), (0, 12, None, "d"), (1, 2, None, "b")], kind)
    for _ in range(2):
        made.batch(second, 1)
        assert out[1] == [(2, "b"), (5, "a")]
    made.batch(spark.createDataFrame([(0, None, 20, None), (1, None, 11, None)], kind), 2)
    assert out[2] == [(7, "c")]


@pytest.mark.parametrize("stream", [False, True])
def test_upserts_become_a_full_changelog(spark, tmp_path, stream):
    kind = "op string, before struct<id:bigint,at:timestamp_ntz,n:double>, after struct<id:bigint,at:timestamp_ntz,n:double>, meta map<string,string>, seq bigint"
    t = dt.datetime(2020, 1, 2, 3, 4, 5, 678901)
    up, gone = lambda i, n, s, at=t: ("REPLACE", None, (i, at, n), None, s), lambda i, s: ("DELETE", (i, None, None), None, None, s)
    batches = [[up(1, 1.5, 1), up(2, None, 1), up(1, 1.5, 2), up(1, 2.5, 3), gone(9, 1)], [gone(1, 5), gone(1, 6), up(2, 3.5, 2), up(2, 3.5, 3), up(1, 7.5, 8)]]
    want = [("INSERT", None, (1, t, 1.5), 1), ("UPDATE", (1, t, 1.5), (1, t, 2.5), 3), ("DELETE", (1, t, 2.5), None, 5), ("INSERT", None, (1, t, 7.5), 8), ("INSERT", None, (2, t, None), 1), ("UPDATE", (2, t, None), (2, t, 3.5), 2)]
    if stream:
        batches[1].append(up(1, 99.5, 2))  # older than what the key has seen
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        for rows in batches:
            spark.createDataFrame(rows, kind).write.mode("append").parquet(f"{tmp_path}/in")
            writer = normalized(spark.readStream.schema(kind).parquet(f"{tmp_path}/in"), ["id"]).writeStream.format("parquet")
            writer.option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        got = spark.read.schema(kind).parquet(f"{tmp_path}/out")
    else:
        got = normalized(spark.createDataFrame(batches[0] + batches[1], kind), ["id"])
    told = [(r["op"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"]), r["seq"]) for r in got.collect()]
    assert sorted(told, key=str) == sorted(want, key=str)


KEYED, LOOSE = Schema.of(("id", "BIGINT"), ("name", "STRING"), keys=["id"]), Schema.of(("id", "BIGINT"), ("name", "STRING"))


def stream_rows(spark, *rows):
    return spark.createDataFrame([(t, s, k, p if isinstance(p, str) else control_row(p) if isinstance(p, Change) else json.dumps(p)) for t, s, k, p in rows], ROW)


def inserted(table, seq, i, **more):
    return (table, seq, "data", {"op": "INSERT", "before": None, "after": row(i, f"n{i}") | more})


def test_a_batch_of_more_than_a_thousand_schema_changes(spark, tmp_path):
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    runtime = Runtime(spark, definition(), sink, f"{tmp_path}/cp")
    tables = [f"app.t{i}" for i in range(1001)]
    runtime.batch(stream_rows(spark, *[(t, 0, "schema", Change(TableId.parse(t), "create.table", schema=KEYED)) for t in tables], inserted("app.t7", 1, 1)), 0)
    runtime.batch(stream_rows(spark, ("app.more", 0, "schema", Change(TableId.parse("app.more"), "create.table", schema=KEYED)), inserted("app.t7", 2, 2)), 1)
    assert sorted(map(tuple, sink.read(TableId.parse("app.t7")).collect())) == [(1, "n1"), (2, "n2")]


def test_tables_of_one_batch_that_share_a_sink(spark, tmp_path):
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    routed = definition(more="route: [{source-table: app.t\\.*, sink-table: ods.all}, {source-table: app.t1, sink-table: ods.one}]")
    tables = [TableId.parse(f"app.t{i}") for i in range(4)]
    rows = [(str(t), 0, "schema", Change(t, "create.table", schema=KEYED)) for t in tables] + [inserted(str(t), 1, i) for i, t in enumerate(tables)] + [inserted("app.other", 1, 9), ("app.other", 0, "schema", Change(TableId.parse("app.other"), "create.table", schema=KEYED))]
    runtime = Runtime(spark, routed, sink, f"{tmp_path}/cp")
    for number in (0, 0):
        runtime.batch(stream_rows(spark, *rows), number)
        assert sorted(r["id"] for r in sink.read(TableId.parse("ods.all")).collect()) == [0, 1, 2, 3]
        assert [r["id"] for r in sink.read(TableId.parse("ods.one")).collect()] == [1] and [r["id"] for r in sink.read(TableId.parse("app.other")).collect()] == [9]


def test_parallel_readers_that_evolve_in_different_order(spark, tmp_path):
    table = TableId.parse("app.t")
    add = lambda name, kind: Change(table, "add.column", added=((Column(name, Type(kind)), "LAST", None),))
    first = [("app.t", 0, "schema", Change(table, "create.table", schema=KEYED)), inserted("app.t", 1, 1), ("app.t", 2, "schema", add("age", "INT")), inserted("app.t", 3, 2, age=7), ("app.t", 4, "schema", add("city", "STRING")), inserted("app.t", 5, 3, age=8, city="Bern")]
    second = [("app.t", 0, "schema", Change(table, "create.table", schema=KEYED)), ("app.t", 1, "schema", add("city", "STRING")), inserted("app.t", 2, 11, city="Rome"), ("app.t", 3, "schema", Change(table, "drop.column", dropped=("name",))), ("app.t", 4, "schema", add("age", "BIGINT")), inserted("app.t", 6, 12, age=1 << 40)]
    want = [(1, "n1", None, None), (2, "n2", 7, None), (3, "n3", 8, "Bern"), (11, "n11", None, "Rome"), (12, None, 1 << 40, None)]
    for way, batches in enumerate(([(first, second)], [(first, []), ([], second)], [([], second), (first, [])], [(first[:4], second[:3]), (first[4:], second[3:])])):
        sink = Files(spark, {"path": f"{tmp_path}/sink{way}"})
        runtime = Runtime(spark, definition(), sink, f"{tmp_path}/cp{way}")
        for number, (a, b) in enumerate(batches):
            parts = [stream_rows(spark, *own).withColumn("reader", F.lit(name)) for name, own in (("a", a), ("b", b)) if own]
            runtime.batch(reduce(lambda x, y: x.unionByName(y), parts), number)
        got = sink.read(table)
        assert sorted(map(tuple, got.select("id", "name", "age", "city").collect())) == want, way
        assert dict(got.dtypes)["age"] == "bigint"


class Cut(Database):
    """Counts the changes of the schema it is sent, and is killed once at a point: before or after the nth statement batch, or
    after a schema change."""

    point, seen, altered = None, 0, None

    def reach(self, what):
        self.seen += 1
        if (self.seen, what) == self.point:
            self.point = None
            raise Dead

    def execute(self, *texts):
        if texts[0].startswith("ALTER") and self.altered is not None:
            self.altered.append(texts[0])
        self.reach("before")
        super().execute(*texts)
        self.seen -= 1
        self.reach("after")


@pytest.mark.parametrize(("behavior", "what", "step"), [("EVOLVE", "after", 1), ("EVOLVE", "before", 3), ("LENIENT", "after", 4), ("TRY_EVOLVE", "after", 4)])
def test_points_of_being_killed_leave_the_same_rows(spark, tmp_path, behavior, what, step):
    keyed, loose = TableId.parse("APP.KEYED"), TableId.parse("APP.LOOSE")
    add = lambda t: Change(t, "add.column", added=((Column("qty", Type("INT")), "LAST", None),))
    batches = [
        stream_rows(spark, *[(str(t), 0, "schema", Change(t, "create.table", schema=s)) for t, s in ((keyed, KEYED), (loose, LOOSE))], inserted("APP.KEYED", 1, 1), inserted("APP.LOOSE", 1, 1)),
        stream_rows(spark, inserted("APP.LOOSE", 2, 2), ("APP.LOOSE", 3, "schema", add(loose)), inserted("APP.LOOSE", 4, 3, qty=7), ("APP.KEYED", 3, "schema", add(keyed)), inserted("APP.KEYED", 4, 2, qty=8)),
    ]
    points, at = 1, 1
    while at <= points:
        url = f"jdbc:derby:{tmp_path}/{at};create=true"
        sink = Cut(spark, {"url": url})
        runtime = Runtime(spark, definition("jdbc", behavior), sink, f"{tmp_path}/cp-{at}")
        sink.altered, sink.seen, sink.point = [], 0, (at, what)
        killed, number = 0, 0
        while number < 2:
            try:
                runtime.batch(batches[number], number)
                number += 1
            except Dead:
                killed += 1
        points = max(points, sink.seen - killed)
        read = lambda t: sorted(map(tuple, spark.read.format("jdbc").options(url=url, dbtable=f'"APP"."{t}"').load().collect()), key=str)  # noqa: B023, E731
        assert killed == 1 and read("KEYED") == [(1, "n1", None), (2, "n2", 8)], at
        assert read("LOOSE") == [(1, "n1", None), (2, "n2", None), (3, "n3", 7)], at
        # a change that was killed before it was made is tried once more, one that was made never
        assert len(sink.altered) - 2 <= (what == "before"), (at, sink.altered)
        at += step
    assert points > 6


STREAM = """
source: {{type: mysql, url: "{url}", keys: {{APP.ITEMS: [ID]}}, discover: {{table: APP.NAMES, column: NAME, where: "WANTED = 1"}}, log.path: "{root}/log", scan.incremental.snapshot.chunk.size: 4, chunks.per.batch: 2}}
sink: {{type: files, path: "{root}/sink"}}
transform: [{{source-table: APP.ITEMS, projection: "ID, UPPER(NAME) AS NAME", filter: "ID > 2"}}]
route: [{{source-table: APP.ITEMS, sink-table: ods.items}}]
pipeline: {{name: stream, schema.change.behavior: EVOLVE, execution.runtime-mode: STREAMING}}
"""


def test_a_definition_runs_as_a_stream_from_the_command_line(spark, tmp_path, capsys):
    url, source = derby(
        spark, tmp_path, "CREATE TABLE APP.ITEMS (ID BIGINT NOT NULL PRIMARY KEY, NAME VARCHAR(20))", "CREATE TABLE APP.NAMES (NAME VARCHAR(20), WANTED INT)",
        f"INSERT INTO APP.ITEMS VALUES {', '.join(f'({i}, {chr(39)}n{i}{chr(39)})' for i in range(20))}", "INSERT INTO APP.NAMES VALUES ('APP.ITEMS', 1), ('APP.OTHERS', 0), ('a.b.c.d.e', 1)",
    )
    up = lambda i, name: {"ID": i, "NAME": name}
    segment(tmp_path, 0, event("u", 1, up(5, "n5"), up(5, "x"), "ITEMS"), event("u", 2, up(6, "n6"), up(1, "n6"), "ITEMS"))
    made = tmp_path / "stream.yaml"
    made.write_text(STREAM.format(url=url, root=tmp_path))
    assert main(["run", str(made), "--check"]) == 0
    assert main(["run", str(made)]) == 2 and "--checkpoint" in capsys.readouterr().err
    assert main(["run", str(tmp_path / "none.yaml")]) == 2
    assert main(["run", str(made), "--checkpoint", f"{tmp_path}/cp", "--until-done"]) == 0
    sink = Files(spark, {"path": f"{tmp_path}/sink"})
    rows = lambda: {r["ID"]: r["NAME"] for r in sink.read(TableId.parse("ods.items")).collect()}
    want = {i: f"N{i}" for i in range(3, 20) if i != 6} | {5: "X"}
    assert rows() == want
    segment(tmp_path, 1, event("d", 3, up(5, "x"), None, "ITEMS"))
    assert main(["run", str(made), "--checkpoint", f"{tmp_path}/cp", "--until-done"]) == 0
    del want[5]
    assert rows() == want
    made.write_text(STREAM.format(url=f"jdbc:derby:{tmp_path}/absent", root=tmp_path))
    assert main(["run", str(made), "--checkpoint", f"{tmp_path}/cp2", "--until-done"]) == 1


def test_large_snapshots_take_no_more_batches(spark, tmp_path):
    """Of one chunk a batch, 200 chunks would take 200 batches; a small table's batches stay as small as they are told to be."""
    def ends(chunks, **options):
        state = tmp_path / f"{'-'.join(map(str, chunks))}-{len(options)}"
        (state / "tables").mkdir(parents=True)
        (state / "start.json").write_text('{"log": 0}')
        for i, n in enumerate(chunks):
            (state / "tables" / f"{i:06}.json").write_text(json.dumps({"table": f"t{i}", "chunks": n, "first": True}))
        reader, out = WorkReader({"state": str(state), "chunks.per.batch": "1", **options}), []
        while True:
            now = reader.latestOffset()
            if out and now == out[-1]:
                return out
            out.append(now)

    large = ends([200, 3])
    assert len(large) <= 16 + 3 and large[-1] == {"log": 0, "t0": 200, "t1": 3}
    assert all(b["t0"] - a["t0"] <= 13 for a, b in zip(large[:-1], large[1:], strict=True)) and all(o["t0"] == 200 for o in large if o["t1"])
    assert [o["t0"] for o in ends([5])] == [1, 2, 3, 4, 5]
    assert len(ends([200], **{"snapshot.batches": "0"})) == 200


def test_events_whose_table_is_escaped_are_found(spark, tmp_path):
    (tmp_path / "log").mkdir()
    lines = [json.dumps(event("c", 1, None, row(1, "x"))), json.dumps(event("c", 2, None, row(2, "y"))).replace('"items"', '"\\u0069tems"'), json.dumps(event("c", 3, None, row(3, "items"), "others"))]
    (tmp_path / "log" / "0").write_text("\n".join(lines))
    made = Follower(spark, Runtime(spark, definition(), Files(spark, {"path": f"{tmp_path}/sink"}), f"{tmp_path}/cp"), f"{tmp_path}/state", f"{tmp_path}/log")
    assert sorted(r["source"]["pos"] for r in made.events(["0"], ITEMS).collect()) == [1, 2]


def test_how_far_a_stream_is(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(30)], "id bigint, name string")
    made = Follower(spark, Runtime(spark, definition(), Files(spark, {"path": f"{tmp_path}/sink"}), f"{tmp_path}/cp"), f"{tmp_path}/state", None, 10)
    made.begin()
    made.add(ITEMS, TableOfFiles(rows, "id", ["id"]))
    told = made.progress()
    assert told.tables("pending") == ["app.items"] and told.chunks_left == {"app.items": 4} and told.segments == 0
    running = follow(made, f"{tmp_path}/cp", interval="0 seconds", chunks_per_batch=3)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    told = made.progress()
    assert told.tables("following") == ["app.items"] and told.chunks_done == {"app.items": 4} and not sum(told.chunks_left.values())


def log_source(spark, tmp_path, kind, lines, **options):
    (tmp_path / "log.json").write_text("\n".join(map(json.dumps, lines)))
    source = open_source(spark, {"type": kind, "log.path": f"{tmp_path}/log.json", "names": ["app.items"], "schemas": {"app.items": [["id", "BIGINT"], ["name", "STRING"]]}, "keys": {"app.items": ["id"]}, **options})
    return source.tables[ITEMS]


def placed(op, place, pos, before, after, **where):
    return {"op": op, "before": before, "after": after, "ts_ms": 7, "source": {"table": "items", "pos": pos} | where}


def test_shards_in_any_order_give_one_table(spark, tmp_path):
    lines = [
        placed("c", "shard", 1, None, row(1, "a"), shard="-80"), placed("u", "shard", 2, row(1, "a"), row(1, "b"), shard="-80"), placed("c", "shard", 1, None, row(2, "a"), shard="80-"),
        placed("u", "shard", 1, row(1, "b"), row(1, "c"), shard="-40"), placed("u", "shard", 9, row(1, "b"), row(1, "stale"), shard="-80"), placed("d", "shard", 2, row(2, "a"), None, shard="80-"), placed("c", "shard", 3, None, row(3, "z"), shard="80-"),
    ]
    for seed in range(3):
        random.Random(seed).shuffle(lines)
        changes = log_source(spark, tmp_path, "vitess", lines, reshards=[{"ended": {"-80": 2}, "begun": ["-40", "40-80"]}])
        assert sorted(map(tuple, materialized(changes, ["id"]).collect())) == [(1, "c"), (3, "z")]
    assert log_source(spark, tmp_path, "vitess", lines, reshards=[{"ended": {"-80": 2}, "begun": ["-40"]}], since={"-80": 2, "80-": 2}).count() == 2


def test_regions_up_to_what_all_have_resolved(spark, tmp_path):
    lines = [placed("u", "region", 9, row(1, "a"), row(1, "late"), region="r2"), placed("u", "region", 5, row(1, "a"), row(1, "b"), region="r1"), placed("c", "region", 3, None, row(1, "a"), region="r1"), placed("c", "region", 3, None, row(1, "a"), region="r1"), {"region": "r1", "resolved": 20}, {"region": "r2", "resolved": 8}, {"region": "r2", "resolved": 2}]
    changes = log_source(spark, tmp_path, "tidb", lines)
    assert sorted((r["seq"], r["op"]) for r in changes.collect()) == [(3, "INSERT"), (5, "UPDATE")]
    assert log_source(spark, tmp_path, "tidb", lines, regions=3).count() == 0


def test_documents_with_those_before_them(spark, tmp_path):
    (tmp_path / "shop.items.json").write_text('{"_id": "a", "n": 1}\n{"_id": "b", "n": 2}')
    stamp = lambda t: {"$timestamp": {"t": t, "i": 1}}
    told = [("update", "a", {"_id": "a", "n": 5}, 1), ("update", "a", {"_id": "a", "n": 5}, 2), ("delete", "b", None, 3), ("insert", "c", {"_id": "c", "n": 9}, 4)]
    (tmp_path / "log.json").write_text("\n".join(json.dumps({"operationType": k, "ns": {"db": "shop", "coll": "items"}, "documentKey": {"_id": i}, "fullDocument": d, "clusterTime": stamp(t)}) for k, i, d, t in told))
    source = open_source(spark, {"type": "mongodb", "names": ["shop.items"], "schemas": {"shop.items": [["_id", "STRING"], ["n", "INT"]]}, "snapshot.path": str(tmp_path), "log.path": f"{tmp_path}/log.json", "scan.full-changelog": "true"})
    got = sorted((r["op"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in source.tables[TableId.parse("shop.items")].collect() if r["seq"] >= 0)
    assert got == [("DELETE", ("b", 2), None), ("INSERT", None, ("c", 9)), ("UPDATE", ("a", 1), ("a", 5))]
