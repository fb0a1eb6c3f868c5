"""Changelogs, rules, routes, evolution, snapshots, formats, definitions, and whole runs."""

import json

import pytest
from pyspark.sql import functions as F

from deltaloom.catalog import Change, Column, Schema, TableId, Type
from deltaloom.functions.udfs import registered, scalar
from deltaloom.operators import changelog, route
from deltaloom.operators.evolve import Registry, SchemaEvolution, coerced
from deltaloom.operators.transform import Transform, TransformRule, options_of, referenced_columns, transform_rows
from deltaloom.plans.definition import DefinitionError, ModelDef, parse
from deltaloom.plans.planner import run
from deltaloom.sinks import formats
from deltaloom.sinks.registry import open_sink
from deltaloom.sources import chunks
from deltaloom.sources.metrics import newly_added, observed
from deltaloom.sources.registry import control_change, control_row, log_events, open_source
from deltaloom.sources.selectors import Selectors
from deltaloom.streaming.runtime import file_stream, start

TABLE = TableId.parse("app.public.users")
USERS = Schema.of(("id", "BIGINT"), ("name", "STRING"), ("age", "INT"), keys=["id"])


def users(spark, rows):
    events = [{"table": str(TABLE), "schema": [["id", "BIGINT"], ["name", "STRING"], ["age", "INT"]], "keys": ["id"], "rows": rows}]
    return open_source(spark, {"type": "values", "events": events}).tables[TABLE]


ROWS = [["INSERT", None, [1, "Ann", 20]], ["INSERT", None, [2, "Bob", 30]], ["UPDATE", [1, "Ann", 20], [1, "Ann", 40]], ["UPDATE", [2, "Bob", 30], [2, "Bob", 10]], ["DELETE", [1, "Ann", 40], None], ["INSERT", None, [3, None, None]]]


def flat(frame):
    return [(r["op"], r["before"] and tuple(r["before"]), r["after"] and tuple(r["after"])) for r in frame.orderBy("seq").collect()]


def test_filter_across_updates(spark):
    out = Transform(TransformRule(str(TABLE), "id, age + 1 AS next", "next > 25"), TABLE, USERS, users(spark, ROWS)).run()
    assert flat(out) == [("INSERT", None, (2, 31)), ("INSERT", None, (1, 41)), ("DELETE", (2, 31), None), ("DELETE", (1, 41), None)]


def test_metadata_and_soft_deletes(spark):
    rule = TransformRule(str(TABLE), "id, __table_name__ AS t, __data_event_type__ AS kind", converter="SOFT_DELETE")
    out = flat(Transform(rule, TABLE, USERS, users(spark, ROWS)).run())
    assert out[2] == ("UPDATE", (1, "users", "-U"), (1, "users", "+U"))
    assert out[4] == ("INSERT", None, (1, "users", "-D"))


def test_output_schema_without_rows(spark):
    one = Transform(TransformRule(str(TABLE), "*, UPPER(name) AS big", "false", primary_keys=("name",), table_options={"a": "b"}), TABLE, USERS, users(spark, ROWS))
    assert one.run().count() == 0
    schema = one.output_schema()
    assert schema.names == ["id", "name", "age", "big"] and schema.primary_keys == ("name",) and not schema["name"].type.nullable and schema.options == {"a": "b"}
    assert referenced_columns(TransformRule("x", "id, UPPER(name) AS n", "n = 'A' AND age > 3"), USERS) == ["id", "name", "age"]


def test_metrics(spark):
    out, seen = observed(users(spark, ROWS), "snapshot")
    assert out.count() == 6
    assert seen.get == {"rows": 6, "inserts": 3, "updates": 2, "replaces": 0, "deletes": 1, "last_seq": 5}
    a, b = TableId.parse("a.b"), TableId.parse("a.c")
    assert newly_added([a], [b, a]) == [b]


def test_models_behind_a_network_are_not_replaced_silently():
    with pytest.raises(ValueError, match="network"):
        registered((), (ModelDef("chat", "OpenAIChatModel", {}),))


MOVED = [["INSERT", None, [1, "Ann", 20]], ["INSERT", None, [2, "Bob", 30]], ["UPDATE", [1, "Ann", 20], [5, "Ann", 21]], ["DELETE", [2, "Bob", 30], None], ["INSERT", None, [7, "Eve", None]]]


def test_change_files_and_their_compaction(spark, tmp_path):
    sink, table = open_sink(spark, {"type": "files", "path": str(tmp_path), "compact.batches": 3}), TableId.parse("app.people")
    rows = lambda: sorted(map(tuple, sink.read(table).collect()), key=str)
    sink.write(table, users(spark, MOVED), USERS, 0)
    assert rows() == [(5, "Ann", 21), (7, "Eve", None)] and sink.pending(table) == [(0, 0)]
    sink.write(table, users(spark, [["DELETE", [7, "Eve", None], None]]), USERS, 1)
    sink.write(table, users(spark, [["DELETE", [7, "Eve", None], None]]), USERS, 1)
    assert rows() == [(5, "Ann", 21)] and sink.pending(table) == [(0, 0), (1, 0)]
    wide = Schema.of(("id", "BIGINT"), ("name", "STRING"), ("age", "BIGINT"), ("city", "STRING"), keys=["id"])
    events = [{"table": "app.people", "schema": [["id", "BIGINT"], ["name", "STRING"], ["age", "BIGINT"], ["city", "STRING"]], "keys": ["id"], "rows": [["INSERT", None, [9, "Ida", 50, "Bern"]]]}]
    more = open_source(spark, {"type": "values", "events": events}).tables[table]
    sink.write(table, more, wide, 2)
    assert rows() == [(5, "Ann", 21, None), (9, "Ida", 50, "Bern")] and sink.versions(table) == [(2, 0)] and sink.folders(table, "changes") == []
    sink.write(table, users(spark, [["UPDATE", [5, "Ann", 21], [6, "Ann", 22]]]), USERS, 3)
    sink.write(table, more, wide, 2)  # an old batch again
    assert rows() == [(6, "Ann", 22), (9, "Ida", 50)]


def test_bulk_lines_of_moved_keys(spark, tmp_path):
    sink = open_sink(spark, {"type": "elasticsearch", "path": str(tmp_path)})
    sink.write(TABLE, users(spark, MOVED), USERS, 0)
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/{TABLE}/batch=0").collect()]
    actions = sorted((kind, one["_id"]) for x in lines if (d := json.loads(x)) and (kind := next(iter(d))) in ("index", "delete") and isinstance(one := d[kind], dict))
    assert actions == [("delete", "1"), ("delete", "2"), ("index", "5"), ("index", "7")]


def test_a_database_by_key(spark, tmp_path):
    """The database that Spark bundles: moved keys, deletions, a batch that comes again, and a failure half-way."""
    sink = open_sink(spark, {"type": "jdbc", "url": f"jdbc:derby:{tmp_path}/db;create=true"})
    table = TableId.parse("app.people")
    sink.execute('CREATE SCHEMA "app"')
    sink.execute('CREATE TABLE "app"."people" ("id" BIGINT NOT NULL PRIMARY KEY, "name" VARCHAR(20), "age" INT)')
    rows = lambda: sorted(map(tuple, spark.read.format("jdbc").options(url=f"jdbc:derby:{tmp_path}/db", dbtable='"app"."people"').load().collect()))
    sink.write(table, users(spark, MOVED), USERS, 0)
    assert rows() == [(5, "Ann", 21), (7, "Eve", None)]
    sink.write(table, users(spark, MOVED), USERS, 0)
    assert rows() == [(5, "Ann", 21), (7, "Eve", None)]
    sink.write(table, users(spark, [["UPDATE", [5, "Ann", 21], [6, "Ann", 22]], ["DELETE", [7, "Eve", None], None]]), USERS, 1)
    assert rows() == [(6, "Ann", 22)]
    with pytest.raises(Exception):  # noqa: B017
        sink.execute('DELETE FROM "app"."people"', 'INSERT INTO "app"."people" ("nothing") VALUES (1)')
    assert rows() == [(6, "Ann", 22)]
    sink.apply(Change(table, "add.column", added=((Column("city", Type("INT")), "LAST", None),)))
    assert sink.statements(Change(table, "table.comment", comment="it's")) == ["COMMENT ON TABLE \"app\".\"people\" IS 'it''s'"]
    assert len(rows()[0]) == 4


def test_a_database_source_in_its_dialect(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    sink = open_sink(spark, {"type": "jdbc", "url": url})
    sink.execute("CREATE TABLE APP.STOCK (ID BIGINT NOT NULL PRIMARY KEY, PRICE DECIMAL(9, 2), NAME VARCHAR(20), SEEN TIMESTAMP, SHARE REAL)")
    sink.execute("INSERT INTO APP.STOCK VALUES (1, 2.50, 'a', '2020-01-02 03:04:05', 0.5), (2, NULL, NULL, NULL, NULL)")
    found = open_source(spark, {"type": "postgres", "url": url, "names": ["APP.STOCK"], "keys": {"APP.STOCK": ["ID"]}})
    (table, schema), = found.schemas.items()
    assert [str(c.type) for c in schema.columns] == ["BIGINT NOT NULL", "DECIMAL(9, 2)", "STRING", "TIMESTAMP(9)", "FLOAT"]
    assert [f.dataType.simpleString() for f in found.tables[table].schema["after"].dataType] == ["bigint", "decimal(9,2)", "string", "timestamp_ntz", "float"]
    assert sorted(r["after"]["ID"] for r in found.tables[table].collect()) == [1, 2]


def test_documents_and_their_change_stream(spark, tmp_path):
    (tmp_path / "shop.items.json").write_text('{"_id": "a", "n": 1}\n{"_id": "b", "n": 2}')
    event = lambda kind, key, i, **more: json.dumps({"operationType": kind, "ns": {"db": "shop", "coll": "items"}, "documentKey": {"_id": key}, "clusterTime": {"$timestamp": {"t": 9, "i": i}}} | more)
    lines = [event("update", "a", 1, fullDocument={"_id": "a", "n": 5}), event("delete", "b", 2), event("insert", "c", 3, fullDocument={"_id": "c", "n": 7}), event("drop", "x", 4)]
    (tmp_path / "log").write_text("\n".join([*lines, event("update", "c", 5, fullDocument={"_id": "c", "n": 8}, fullDocumentBeforeChange={"_id": "c", "n": 7})]))
    options = {"type": "mongodb", "names": ["shop.items"], "schemas": {"shop.items": [["_id", "STRING"], ["n", "INT"]]}, "snapshot.path": str(tmp_path), "log.path": f"{tmp_path}/log"}
    changes = open_source(spark, options).tables[TableId.parse("shop.items")]
    assert sorted(map(tuple, changelog.materialized(changelog.validated(changes), ["_id"]).collect())) == [("a", 5), ("c", 8)]
    assert [r["op"] for r in changes.orderBy("seq").collect()] == ["INSERT", "INSERT", "REPLACE", "DELETE", "INSERT", "UPDATE"]


def test_models(spark):
    made = registered((), (ModelDef("chat", "LocalChat", {"prompt": "> "}), ModelDef("embed", "LocalEmbedding", {"dimensions": "4"})))
    got = transform_rows(spark.sql("select 'hello' a union all select ''"), "chat(a) AS c, EMBED(a) AS e", udfs=made).orderBy("c").collect()
    assert [r["c"] for r in got] == ["> ", "> hello"] and got[0]["e"] == [] and len(got[1]["e"]) == 4


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr("id", "if(id % 7 = 0, null, id) as x", "'a' as s").write.parquet(f"{tmp_path}/t")
    rows = spark.read.parquet(f"{tmp_path}/t")
    out = transform_rows(rows, "id, x + 1 AS y", "x > 5 AND s <> 'b' AND (id IN (8, 9, 20) OR id BETWEEN 30 AND 40)")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert transform_rows(rows, "CAST(s AS INT) AS n, CAST('1e3' AS INT) AS k, CAST(' -7.9 ' AS BIGINT) AS m, CAST('1e30' AS BIGINT) AS big, CAST('-1e30' AS BIGINT) AS low, CAST('NaN' AS INT) AS z, CAST('9e9' AS SMALLINT) AS w").first() == (None, 1000, -7, 2**63 - 1, -(2**63), 0, -1)
    assert "GreaterThan(x,5)" in plan and "ReadSchema: struct<id:bigint,x:bigint,s:string>" in plan
    assert sorted(r["id"] for r in out.collect()) == [8, 9, 20, 30, 31, 32, 33, 34, 36, 37, 38, 39, 40]
    assert transform_rows(rows, "id", "x <> 3").count() == 99


def test_wrong_sides_fail(spark):
    with pytest.raises(Exception, match="wrong sides"):
        users(spark, [["DELETE", None, [1, "x", 2]]]).collect()


def test_materialized(spark):
    got = sorted(map(tuple, changelog.materialized(users(spark, ROWS), ["id"]).collect()))
    assert got == [(2, "Bob", 10), (3, None, None)]
    moved = users(spark, [["INSERT", None, [1, "a", 1]], ["UPDATE", [1, "a", 1], [5, "a", 1]]])
    assert [r["id"] for r in changelog.materialized(moved, ["id"]).collect()] == [5]
    assert changelog.exploded(users(spark, ROWS)).count() == 8
    assert changelog.append_only(users(spark, ROWS)).count() == 8


def test_selectors():
    assert Selectors("app.public.user_?s").matches(TABLE) and not Selectors("app.public.user").matches(TABLE)
    assert Selectors(r"app.\.*.\.*").matches(TABLE) and not Selectors("public.users").matches(TABLE)
    assert Selectors(r"a.b,app.public.[a-z]{1\,9}").matches(TABLE)
    assert not Selectors(r"app.public.\.*", "app.public.users").matches(TABLE)


def test_routes():
    a, b = TableId.parse("db.t_1"), TableId.parse("db.t_2")
    rules = [route.RouteRule(r"db.t_\.*", "ods.all"), route.RouteRule("db.t_1", "copy.<>", "<>"), route.RouteRule("(db).(t_2)", "$1_$2.x")]
    assert list(map(str, route.targets(a, rules))) == ["ods.all", "copy.t_1"]
    assert list(map(str, route.targets(b, rules))) == ["ods.all", "db_t_2.x"]
    assert list(map(str, route.targets(a, rules, "FIRST_MATCH"))) == ["ods.all"]
    assert route.targets(TABLE, rules) == [TABLE]
    assert {str(k): list(map(str, v)) for k, v in route.routed([a, b], rules[:1]).items()} == {"ods.all": ["db.t_1", "db.t_2"]}


def test_shards_widen(spark):
    one, two = spark.sql("select 1 id, 'a' x"), spark.sql("select 2L id, 1.5D y")
    got = route.merged_rows({"one": one, "two": two})
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "string", "double"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", None), (2, None, 1.5)]


def test_coercion(spark):
    source = Schema.of(("a", "STRING"), ("b", "BYTES"))
    target = Schema.of(("b", "STRING"), ("a", "INT"), ("c", "DOUBLE"))
    frame = spark.sql("select named_struct('a', 'x1', 'b', cast('hi' as binary)) r")
    assert tuple(frame.select(coerced(F.col("r"), source, target).alias("r")).first()["r"]) == ("aGk=", None, None)
    with pytest.raises(Exception, match="CAST_INVALID"):
        frame.select(coerced(F.col("r"), source, target, False).alias("r")).collect()


def test_evolution():
    add = Change(TABLE, "add.column", added=((Column("x", Type("INT")), "LAST", None),))
    drop = Change(TABLE, "drop.column", dropped=("name",))
    create = Change(TABLE, "create.table", schema=USERS)
    for behavior, want in (("LENIENT", ["id", "name", "age", "x"]), ("EVOLVE", ["id", "age", "x"]), ("IGNORE", ["id", "name", "age"])):
        e = SchemaEvolution(behavior)
        for change in (create, create, add, add, drop):
            e.arrive(change, TABLE)
        assert e.registry.sinks[str(TABLE)].names == want
        assert Registry.load(e.registry.dump()).sinks == e.registry.sinks
    strict = SchemaEvolution("EXCEPTION")
    strict.arrive(create, TABLE)
    with pytest.raises(ValueError):
        strict.arrive(add, TABLE)

    def refuse(change):
        if change.kind == "drop.column":
            raise RuntimeError("no")

    soft = SchemaEvolution("TRY_EVOLVE")
    for change in (create, drop, add):
        soft.arrive(change, TABLE, refuse)
    assert soft.registry.sinks[str(TABLE)].names == ["id", "name", "age", "x"]
    hard = SchemaEvolution("EVOLVE")
    hard.arrive(create, TABLE)
    with pytest.raises(RuntimeError):
        hard.arrive(drop, TABLE, refuse)


def test_chunks(spark):
    got = [tuple(r) for r in chunks.even_chunks(spark.range(0, 101), "id", 25).orderBy("chunk_id").collect()]
    assert got == [(0, None, 25), (1, 25, 50), (2, 50, 75), (3, 75, 100), (4, 100, None)]
    rows = spark.range(0, 950).select(F.format_string("k%04d", "id").alias("k"))
    got = [tuple(r) for r in chunks.uneven_chunks(rows, "k", 100).orderBy("chunk_id").collect()]
    assert got == [(i, f"k{i * 100:04d}" if i else None, f"k{i * 100 + 100:04d}" if i < 9 else None) for i in range(10)]
    heavy = spark.createDataFrame([(k,) for k in [1] * 30 + [2] * 3 + [3] * 25 + [4, 5, 6]], "k int")
    got = [tuple(r) for r in chunks.uneven_chunks(heavy, "k", 10).orderBy("chunk_id").collect()]
    assert got == [(0, None, 2), (1, 2, 3), (2, 3, 6), (3, 6, None)]
    assert chunks.predicates([(None, 5), (5, None)], "id", True) == ["id >= 5", "id < 5"]
    assert chunks.is_even(spark.range(10), "id") and not chunks.is_even(rows, "k")
    assert chunks.uneven_chunks(rows.limit(0), "k").count() == 1 and chunks.even_chunks(spark.range(0), "id", 5).count() == 0


def test_a_table_is_dealt_in_order_to_several_tasks(spark):
    side = F.struct("id", F.create_map(F.lit("k"), "id").alias("m"))
    for row in (side, F.struct("id")):
        log = spark.range(4000).select(F.lit("app.t").alias("table_id"), F.lit("INSERT").alias("op"), F.lit(None).cast(spark.range(1).select(row.alias("r")).schema["r"].dataType).alias("before"), row.alias("after"), F.expr("least(id div 10, 200L)").alias("seq"))
        dealt = changelog.partitioned(log, "TABLE_ID", count=4)
        parts = [[(r["seq"], r["after"]["id"]) for r in p] for p in dealt.rdd.glom().collect()]
        assert sorted(k for p in parts for _, k in p) == list(range(4000)) and max(map(len, parts)) < 2000
        assert [q for p in parts for q, _ in p] == sorted(q for p in parts for q, _ in p)


def test_changes_of_one_chunk_are_shared_out(spark):
    log = spark.range(1000).select(F.lit("INSERT").alias("op"), F.lit(None).cast("struct<id:bigint>").alias("before"), F.struct("id").alias("after"), F.col("id").alias("seq"))
    marks = spark.createDataFrame([(None, 5, 3), (5, None, 100)], "low bigint, high bigint, high_mark bigint")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        got = chunks.after_snapshot(log, marks, "id").select("seq", F.spark_partition_id().alias("part")).collect()
    finally:
        spark.conf.unset(key)
    assert sorted(r["seq"] for r in got) == [4, *range(101, 1000)]
    assert len({r["part"] for r in got}) == 4  # all of the session


def test_backfill_and_log(spark):
    snapshot = spark.sql("select 1L id, 'a' name, 1 age union all select 2L, 'b', 2")
    log = users(spark, [["UPDATE", [1, "a", 1], [1, "z", 1]], ["DELETE", [2, "b", 2], None], ["INSERT", None, [4, "d", 4]]])
    assert sorted(map(tuple, chunks.backfilled(snapshot, log, ["id"], 0, 1).collect())) == [(1, "z", 1)]
    marks = spark.createDataFrame([(None, 3, 1), (3, None, 5)], "low bigint, high bigint, high_mark bigint")
    assert [r["seq"] for r in chunks.after_snapshot(log, marks, "id").collect()] == []
    assert chunks.started(log, "specific-offset", 1, skip_events=1).count() == 1 and chunks.started(log, "snapshot").count() == 0
    gaps = log.withColumn("seq", F.col("seq") * 100)
    assert [r["seq"] for r in chunks.started(gaps, "specific-offset", 0, skip_events=1, skip_rows=1).collect()] == [200]
    assert chunks.started(gaps, "specific-offset", 0, skip_events=9).count() == 0
    many = spark.createDataFrame([(None if i == 0 else i * 10, None if i == 600 else i * 10 + 10, i) for i in range(601)], "low bigint, high bigint, high_mark bigint")
    wide = spark.range(0, 7000, 7).select(F.lit("INSERT").alias("op"), F.lit(None).cast(log.schema["before"].dataType).alias("before"), F.struct("id", F.lit("n").alias("name"), F.lit(1).alias("age")).alias("after"), F.lit(None).cast("map<string,string>").alias("meta"), F.lit(300).cast("bigint").alias("seq"))
    assert sorted(r["after"]["id"] for r in chunks.after_snapshot(wide, many, "id").collect()) == [k for k in range(0, 7000, 7) if k // 10 < 300]
    with pytest.raises(ValueError):
        chunks.started(log, "never")


def test_messages(spark):
    rows = users(spark, ROWS)
    first = json.loads(formats.debezium_json(rows, TABLE).orderBy("seq").first()["value"])
    assert first == {"before": None, "after": {"id": 1, "name": "Ann", "age": 20}, "op": "c", "source": {"db": "public", "table": "users"}}
    gone = json.loads(formats.canal_json(rows.where("op = 'DELETE'"), TABLE, ["id"]).first()["value"])
    assert gone == {"old": None, "data": [{"id": 1, "name": "Ann", "age": 40}], "type": "DELETE", "database": "public", "table": "users", "pkNames": ["id"]}
    wrapped = json.loads(formats.debezium_json(rows, TABLE, True, USERS).first()["value"])
    assert set(wrapped) == {"schema", "payload"} and wrapped["schema"]["fields"][0]["fields"][0] == {"type": "int64", "optional": False, "field": "id", "name": None}
    back = log_events(formats.debezium_json(rows, TABLE), TABLE, USERS.spark())
    assert [r["op"] for r in back.collect()].count("UPDATE") == 2
    out = formats.kafka_rows(rows, TABLE, ["id"], "canal-json", "csv", mapping={str(TABLE): "topic"}, partition="hash-by-key", headers=True).first()
    assert out["topic"] == "topic" and out["key"] == "app.public.users,1" and out["headers"][2]["value"] == b"users"


def test_type_dialects():
    assert [str(formats.from_mysql(x)) for x in ("tinyint(1)", "BIGINT UNSIGNED", "int unsigned", "decimal(65,1)", "bit(9)", "timestamp(3)", "longtext", "year", "enum('a')")] == ["BOOLEAN", "DECIMAL(20, 0)", "BIGINT", "STRING", "BINARY(2)", "TIMESTAMP_LTZ(3)", "STRING", "INT", "STRING"]
    assert str(formats.from_mysql("tinyint(1)", False)) == "TINYINT"
    with pytest.raises(ValueError):
        formats.from_mysql("set('a')")
    assert [str(formats.from_postgres(x)) for x in ("numeric", "numeric(8,2)", "timestamptz", "oid", "bit(3)", "uuid")] == ["DECIMAL(38, 0)", "DECIMAL(8, 2)", "TIMESTAMP_TZ(6)", "BIGINT", "BYTES", "STRING"]
    assert [str(formats.from_oracle(x)) for x in ("NUMBER(8,2)", "NUMBER", "TIMESTAMP(6) WITH LOCAL TIME ZONE", "CLOB", "RAW")] == ["DECIMAL(8, 2)", "BIGINT", "TIMESTAMP_LTZ(6)", "STRING", "BYTES"]
    assert [str(formats.from_sqlserver(x)) for x in ("money", "tinyint", "datetimeoffset", "datetime")] == ["DECIMAL(19, 4)", "SMALLINT", "TIMESTAMP_LTZ(7)", "TIMESTAMP(3)"]
    assert formats.to_doris(Type("CHAR", (10,))) == "CHAR(30)" and formats.to_starrocks(Type("VARCHAR", (10,))) == "VARCHAR(30)" and formats.to_elasticsearch(Type("DECIMAL", (5, 1))) == "STRING"


class AddN:
    def open(self, options):
        self.n = int(options.get("n", 1))

    def eval(self, x: int) -> int:
        return None if x is None else int(x) + self.n

    def eval_text(self, x: str) -> str:
        return f"{x}+{self.n}"


def test_udfs(spark):
    got = transform_rows(spark.sql("select 1L a, 'x' b"), "addn(a) AS a2, ADDN(b) AS b2, upper(a) AS up", udfs={"AddN": lambda c, types: scalar(AddN, {"n": "5"})(c, types=types), "upper": lambda c, types: c + 100})
    assert tuple(got.first())[:1] == (6,) and got.first()["up"] == 101


DEFINITION = """
source:
  type: values
  name: people
  events:
    - table: app.users_1
      schema: [[id, BIGINT], [name, STRING]]
      keys: [id]
      rows: [[INSERT, null, [1, ann]], [INSERT, null, [2, bob]], [DELETE, [1, ann], null]]
    - table: app.users_2
      schema: [[id, INT], [name, STRING], [city, STRING]]
      keys: [id]
      rows: [[INSERT, null, [7, eve, Bonn]]]
sink: {type: %s, path: "%s"}
transform:
  - source-table: app.users_1
    projection: \\*, UPPER(name) AS name
  - source-table: app.\\.*
    filter: name <> 'nobody'
route:
  - source-table: app.users_\\.*
    sink-table: ods.users
pipeline:
  name: test
  partition.strategy: PRIMARY_KEY
  execution.runtime-mode: BATCH
"""


def test_whole_run(spark, tmp_path):
    values = run(spark, DEFINITION % ("values", ""))
    assert sorted(map(tuple, values.materialized("ods.users").collect())) == [(2, "BOB", None), (7, "eve", "Bonn")]
    assert [c.kind for c in values.events] == ["create.table"]
    files = run(spark, DEFINITION % ("files", tmp_path))
    assert files.seen["ods.users"].get["rows"] > 0 and values.seen == {}
    run(spark, DEFINITION % ("files", tmp_path), sink=files, batch=1)
    assert sorted(map(tuple, files.read(TableId.parse("ods.users")).collect())) == [(2, "BOB", None), (7, "eve", "Bonn")]
    with pytest.raises(ValueError, match="own hash"):
        run(spark, DEFINITION % ("kafka", tmp_path))
    run(spark, (DEFINITION % ("kafka", tmp_path)).replace("PRIMARY_KEY", "SINK_DEFINED"))
    assert spark.read.json(f"{tmp_path}/ods.users/batch=0").count() == 4


@pytest.mark.parametrize(
    "text",
    [
        "sink: {type: values}", "source: {type: values}", "source: {type: values}\nsink: {type: values}\nwhatever: 1", "source: {type: values}\nsink: {type: values}\nroute: {a: b}",
        "source: {type: values}\nsink: {type: values}\ntransform: [{projection: a}]", "source: {type: values}\nsink: {type: values}\ntransform: [{source-table: a, oops: b}]", "source: {name: x}\nsink: {type: values}",
        "source: {type: values}\nsink: {type: values}\npipeline: {schema.change.behavior: SOMETIMES}", "source: {type: values}\nsink: {type: values}\npipeline: {local-time-zone: PST}", "source: [", "source: {type: values, include.schema.changes: [all]}\nsink: {type: values}",
    ],
)
def test_bad_definitions(text):
    with pytest.raises(DefinitionError):
        parse(text)


def test_definitions():
    d = parse(DEFINITION % ("values", ""), {"parallelism": 4, "name": "global"})
    assert d.config["parallelism"] == 4 and d.config["name"] == "test" and not d.streaming and d.config["route-mode"] == "ALL_MATCH"
    assert options_of("a=1; b=2", ";") == {"a": "1", "b": "2"}
    with pytest.raises(ValueError):
        options_of("a")


def test_stream_with_schema_changes_and_restart(spark, tmp_path):
    definition = parse(
        "source: {type: values}\nsink: {type: values}\ntransform: [{source-table: app.users, projection: '\\*, id * 2 AS twice'}]\nroute: [{source-table: app.users, sink-table: ods.users}]\npipeline: {name: stream, schema.change.behavior: EVOLVE}"
    )
    table, sink = TableId.parse("app.users"), open_sink(spark, {"type": "values"})
    schema = Schema.of(("id", "BIGINT"), ("name", "STRING"), keys=["id"])

    def data(seq, op, before, after):
        return json.dumps({"table_id": "app.users", "seq": seq, "kind": "data", "payload": json.dumps({"op": op, "before": before, "after": after})})

    def change(seq, c):
        return json.dumps({"table_id": "app.users", "seq": seq, "kind": "schema", "payload": control_row(c)})

    add = Change(table, "add.column", added=((Column("age", Type("INT")), "LAST", None),))
    assert control_change(control_row(add)) == add
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text("\n".join([change(0, Change(table, "create.table", schema=schema)), data(1, "INSERT", None, {"id": 1, "name": "a"}), change(2, add), data(3, "UPDATE", {"id": 1, "name": "a"}, {"id": 1, "name": "b", "age": 9})]))
    start(spark, file_stream(spark, str(source)), definition, sink, str(tmp_path / "cp"), True).awaitTermination()
    (source / "2.json").write_text("\n".join([data(4, "INSERT", None, {"id": 2, "name": "c", "age": 5})]))
    start(spark, file_stream(spark, str(source)), definition, sink, str(tmp_path / "cp"), True).awaitTermination()
    assert [c.kind for c in sink.events] == ["create.table", "add.column"]
    assert len(sink.batches["ods.users"]) == 3
    got = sorted((r["id"], r["name"], r["age"], r["twice"]) for r in sink.materialized("ods.users").collect())
    assert got == [(1, "b", 9, 2), (2, "c", 5, 4)]
