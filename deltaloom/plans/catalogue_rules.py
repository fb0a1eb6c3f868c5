"""More of the query catalogue: further functions and startup modes; and rules: what the planner decides about types and schemas,
as rows with the SQL that lists them. Rules read no table's rows, so they are checked by the tests and are no queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom import catalog as S
from deltaloom.catalog import Change, Column, Schema, TableId, Type
from deltaloom.operators import changelog
from deltaloom.operators.evolve import SchemaEvolution, coerced
from deltaloom.operators.transform import Transform, TransformRule, referenced_columns, rule_for, transform_rows
from deltaloom.plans.catalogue import CHANGES_SQL, EVENTS, FLAT_SQL, flat, narrow_changes, query, read, transformed, user_changes
from deltaloom.sinks import formats
from deltaloom.sources import chunks as C
from deltaloom.sources.registry import log_events, open_source
from deltaloom.sources.selectors import Selectors

RULES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}


def rule(sql: str) -> Callable:
    def add(made: Callable) -> Callable:
        RULES[made.__name__] = made, sql
        return made

    return add


# Functions

transformed(
    "round_forms", "lineitem",
    "l_orderkey, l_linenumber, ROUND(l_quantity / 8, 2) AS r2, ROUND(l_quantity / 8) AS r0, ROUND(l_linenumber, 1) AS whole, ROUND(CAST(l_quantity / 8 AS DECIMAL(10, 3)), 1) AS d", None,
    "SELECT l_orderkey, l_linenumber, round(l_quantity / 8, 2) AS r2, round(l_quantity / 8) AS r0, l_linenumber AS whole, CAST(round(CAST(l_quantity / 8 AS DECIMAL(10, 3)), 1) AS DECIMAL(9, 1)) AS d FROM lineitem",
)
transformed(
    "place_forms", "customer",
    "c_custkey, INSTR(c_name, '#') AS i, INSTR(c_name, 'zz') AS none, LOCATE('0', c_name, 12) AS l, REGEXP_INSTR(c_name, '[1-9]') AS r", None,
    """SELECT c_custkey, CAST(instr(c_name, '#') AS INTEGER) AS i, CAST(0 AS INTEGER) AS none, CAST(CASE WHEN contains(substr(c_name, 12), '0') THEN instr(substr(c_name, 12), '0') + 11 ELSE 0 END AS INTEGER) AS l,
       CAST(CASE WHEN regexp_matches(c_name, '[1-9]') THEN instr(c_name, regexp_extract(c_name, '[1-9]')) ELSE 0 END AS INTEGER) AS r FROM customer""",
)
transformed(
    "uuid_forms", "customer", "c_custkey, UUID(FROM_BASE64_BINARY(TO_BASE64(c_name))) AS named, CHAR_LENGTH(UUID()) AS n", None,
    """SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-3' || substr(h, 14, 3) || '-' || substr('89ab', CAST((instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1 AS INTEGER), 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS named,
       CAST(36 AS INTEGER) AS n FROM (SELECT c_custkey, md5(c_name) AS h FROM customer)""",
)
transformed(
    "clock_parts", "events", "event_id, HOUR(ts) AS h, MINUTE(ts) AS m, EXTRACT(MINUTE FROM ts) AS e, SECOND(ts) AS s", None,
    "SELECT event_id, CAST(hour(ts) AS BIGINT) AS h, CAST(minute(ts) AS BIGINT) AS m, CAST(minute(ts) AS BIGINT) AS e, CAST(second(ts) AS BIGINT) AS s FROM events",
)
transformed(
    "zone_forms", "orders",
    "o_orderkey, DATE_FORMAT_TZ(o_orderdate, 'yyyy-MM-dd HH:mm', 'Asia/Tokyo') AS local, DATE_FORMAT_TZ(TO_TIMESTAMP_LTZ(o_orderkey * 1000, 3), 'yyyy-MM-dd HH:mm:ss', 'Asia/Tokyo') AS tokyo, "
    "CAST(TO_TIMESTAMP_LTZ(o_orderkey, 0) AS STRING) AS seconds, CAST(TO_TIMESTAMP_LTZ('2003-02-01 04:05:06.500') AS STRING) AS read, CAST(TO_DATE(TO_TIMESTAMP_LTZ(o_orderkey * 1000, 3)) AS STRING) AS day", None,
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS local, strftime(make_timestamp(o_orderkey * 1000000) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S') AS tokyo,
       strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%dT%H:%M:%S') AS seconds, '2003-02-01T04:05:06.5' AS read, strftime(make_timestamp(o_orderkey * 1000000), '%Y-%m-%d') AS day FROM orders""",
)
transformed(
    "cast_wide", "lineitem",
    "l_orderkey, l_linenumber, CAST(l_quantity / 8 AS DECIMAL(12, 1)) AS d, CAST('12.345' AS DECIMAL(6, 2)) AS t, CAST(l_returnflag AS DECIMAL(5, 1)) AS junk, CAST(l_linestatus AS DOUBLE) AS none, CAST('1999-12-31T23:59:58' AS TIMESTAMP(6)) AS at, CAST(l_linenumber AS STRING) AS s", None,
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity / 8 AS DECIMAL(12, 1)) AS d, CAST(12.35 AS DECIMAL(6, 2)) AS t, CAST(NULL AS DECIMAL(5, 1)) AS junk, CAST(NULL AS DOUBLE) AS none,
       TIMESTAMP '1999-12-31 23:59:58' AS at, CAST(l_linenumber AS VARCHAR) AS s FROM lineitem""",
)
transformed(
    "unknown_forms", "orders",
    "o_orderkey, (o_totalprice > 100000 AND CAST(NULL AS BOOLEAN)) IS UNKNOWN AS u, (o_totalprice > 100000 OR CAST(NULL AS BOOLEAN)) IS UNKNOWN AS v, (o_orderstatus = 'F') IS NOT TRUE AS w, (o_orderstatus = 'F') IS FALSE AS x", None,
    "SELECT o_orderkey, p AS u, NOT p AS v, NOT f AS w, NOT f AS x FROM (SELECT o_orderkey, coalesce(o_totalprice > 100000, false) AS p, coalesce(o_orderstatus = 'F', false) AS f FROM orders)",
)
transformed(
    "now_forms", "nation",
    "n_nationkey, CURRENT_TIMESTAMP > TO_TIMESTAMP_LTZ('2020-01-01 00:00:00.000') AS a, NOW() > TO_TIMESTAMP_LTZ('2020-01-01 00:00:00.000') AS b, LOCALTIMESTAMP > TO_TIMESTAMP('2020-01-01 00:00:00') AS c, CURRENT_DATE > TO_DATE('2020-01-01') AS d, UNIX_TIMESTAMP() > 1577836800 AS e", None,
    "SELECT n_nationkey, true AS a, true AS b, true AS c, true AS d, true AS e FROM nation",
)


@query("SELECT c_custkey, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS none, c_name AS first, CAST(c_nationkey AS BIGINT) AS second, c_name AS named FROM customer")
def map_row_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select(
        "c_custkey", F.create_map(F.lit("segment"), "c_mktsegment").alias("m"), F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("nation")).alias("r")
    )
    return transform_rows(rows, "c_custkey, m['segment'] AS segment, m['x'] AS none, r[1] AS first, r[2] AS second, r.name AS named")


# Startup modes: a log whose seq is the event's number


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    made = changelog.envelope(rows.drop("ts"))
    op_ts = F.create_map(F.lit("op_ts"), F.expr("cast(unix_millis(cast(ts as timestamp)) as string)"))
    return rows.select(F.lit("INSERT").alias("op"), F.lit(None).cast(made.schema["before"].dataType).alias("before"), F.struct("event_id", "event_type").alias("after"), op_ts.alias("meta"), F.col("event_id").alias("seq"))


def startup(name: str, sql: str, *given: object, **options: object) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return C.started(event_log(spark, sf_dir), *given, **options).select("op", "seq", "after.*")

    run.__name__ = name
    query("SELECT 'INSERT' AS op, event_id AS seq, event_id, event_type FROM events" + sql)(run)


startup("startup_initial", "", "initial")
startup("startup_earliest", "", "earliest-offset")
startup("startup_latest", " WHERE event_id > 500", "latest-offset", latest=500)
startup("startup_snapshot", " WHERE false", "snapshot")
startup("startup_timestamp", " WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'", "timestamp", millis=1_704_844_800_000)
startup("startup_skips", " WHERE event_id >= 100 AND event_id NOT IN (SELECT event_id FROM events WHERE event_id >= 100 ORDER BY event_id LIMIT 7)", "specific-offset", 100, skip_events=5, skip_rows=2)


# Sources, changelogs and partitions


@query(FLAT_SQL)
def partition_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(changelog.partitioned(user_changes(spark, sf_dir).withColumn("table_id", F.lit("app.events")), "TABLE_ID").drop("table_id"))


@query(
    CHANGES_SQL
    + """SELECT op, CASE WHEN op <> 'INSERT' THEN user_id END AS b_user_id, CASE WHEN op <> 'INSERT' THEN p_event_id END AS b_event_id, CASE WHEN op <> 'INSERT' THEN p_type END AS b_event_type,
      CASE WHEN op <> 'DELETE' THEN user_id END AS a_user_id, CASE WHEN op <> 'DELETE' THEN event_id END AS a_event_id, CASE WHEN op <> 'DELETE' THEN event_type END AS a_event_type FROM changes"""
)
def event_messages_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events written as JSON and read back."""
    table, changes = TableId.parse("app.public.events"), narrow_changes(spark, sf_dir)
    return flat(log_events(formats.debezium_json(changes, table), table, changes.schema["after"].dataType)).drop("seq")


@rule("SELECT 'UPDATE' AS op, 1 AS b_id, 'x' AS b_name, 1 AS a_id, 'y' AS a_name UNION ALL SELECT 'INSERT', NULL, NULL, 1, 'x' UNION ALL SELECT 'DELETE', 1, 'y', NULL, NULL")
def values_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [["INSERT", None, [1, "x"]], ["UPDATE", [1, "x"], [1, "y"]], ["DELETE", [1, "y"], None]]
    events = [{"table": "app.t", "schema": [["id", "INT"], ["name", "STRING"]], "keys": ["id"], "rows": rows}]
    return flat(open_source(spark, {"type": "values", "events": events}).tables[TableId.parse("app.t")]).drop("seq")


@rule("SELECT 'app.orders_' || i AS table_id FROM range(0, 20) r(i) WHERE i % 10 <> 3 AND i <> 7 UNION ALL SELECT 'app.users'")
def selected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [TableId.parse(f"{a}.{b}") for a in ("app", "old") for b in ("users", "stock", *(f"orders_{i}" for i in range(20)))]
    kept = Selectors(r"app.orders_\.*, app.users", r"app.orders_\.?3, \.*.orders_7").select(tables)
    return spark.createDataFrame([(str(t),) for t in kept], "table_id string")


@query("SELECT CASE o_orderstatus WHEN 'F' THEN 'app.done' ELSE 'app.open' END AS table_id, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'first' ELSE 'second' END AS rule FROM orders WHERE o_orderstatus IN ('F', 'O')")
def first_match_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rules that match a table only the first applies; tables that none matches are left out here."""
    rules = [TransformRule("app.done", "o_orderkey, 'first' AS rule"), TransformRule(r"app.\.*", "o_orderkey, 'second' AS rule"), TransformRule("app.done", "o_orderkey, 'never' AS rule")]
    orders, out = read(spark, sf_dir, "orders"), None
    for name, status in (("app.done", "F"), ("app.open", "O"), ("else.where", "P")):
        if rule := rule_for(TableId.parse(name), rules):
            one = transform_rows(orders.where(F.col("o_orderstatus") == status), rule.projection).select(F.lit(name).alias("table_id"), "*")
            out = one if out is None else out.unionByName(one)
    return out


# What the planner decides, as rows


def listed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


#: The documented type of each source type.
SOURCE_TYPES = {
    "mysql": [("TINYINT(1)", "BOOLEAN"), ("TINYINT UNSIGNED", "SMALLINT"), ("MEDIUMINT", "INT"), ("INT UNSIGNED", "BIGINT"), ("BIGINT", "BIGINT"), ("BIGINT UNSIGNED", "DECIMAL(20, 0)"), ("DECIMAL(10, 4)", "DECIMAL(10, 4)"), ("DECIMAL(65, 1)", "STRING"), ("BIT(1)", "BOOLEAN"), ("BIT(9)", "BINARY(2)"), ("DATETIME(3)", "TIMESTAMP(3)"), ("TIMESTAMP(6)", "TIMESTAMP_LTZ(6)"), ("YEAR", "INT"), ("LONGTEXT", "STRING"), ("BLOB", "BYTES"), ("JSON", "STRING")],
    "postgres": [("BOOL", "BOOLEAN"), ("INT2", "SMALLINT"), ("SERIAL", "INT"), ("INT8", "BIGINT"), ("FLOAT4", "FLOAT"), ("FLOAT8", "DOUBLE"), ("NUMERIC(8, 2)", "DECIMAL(8, 2)"), ("NUMERIC", "DECIMAL(38, 0)"), ("TIMESTAMP(3)", "TIMESTAMP(3)"), ("TIMESTAMPTZ", "TIMESTAMP_TZ(6)"), ("BYTEA", "BYTES"), ("UUID", "STRING"), ("BIT(3)", "BYTES")],
    "oracle": [("NUMBER(8, 2)", "DECIMAL(8, 2)"), ("NUMBER", "BIGINT"), ("FLOAT", "DOUBLE"), ("BINARY_FLOAT", "FLOAT"), ("DATE", "TIMESTAMP(0)"), ("TIMESTAMP(6) WITH LOCAL TIME ZONE", "TIMESTAMP_LTZ(6)"), ("TIMESTAMP(3) WITH TIME ZONE", "TIMESTAMP_TZ(3)"), ("CLOB", "STRING"), ("RAW", "BYTES")],
    "sqlserver": [("BIT", "BOOLEAN"), ("TINYINT", "SMALLINT"), ("FLOAT", "DOUBLE"), ("MONEY", "DECIMAL(19, 4)"), ("NUMERIC(12, 3)", "DECIMAL(12, 3)"), ("DATETIME", "TIMESTAMP(3)"), ("DATETIME2(5)", "TIMESTAMP(5)"), ("DATETIMEOFFSET", "TIMESTAMP_LTZ(7)"), ("VARBINARY", "BYTES"), ("NVARCHAR", "STRING")],
}
#: The documented type of each sink for a type of the model.
SINK_TYPES = {
    "doris": [("CHAR(10)", "CHAR(30)"), ("CHAR(100)", "VARCHAR(300)"), ("VARCHAR(20000)", "VARCHAR(60000)"), ("VARCHAR(30000)", "STRING"), ("TIME(3)", "STRING"), ("TIMESTAMP(9)", "DATETIME(6)"), ("BYTES", "STRING")],
    "starrocks": [("CHAR(10)", "CHAR(30)"), ("CHAR(100)", "VARCHAR(300)"), ("STRING", "VARCHAR(1048576)"), ("TIMESTAMP(3)", "DATETIME"), ("TIME(0)", "VARCHAR(20)")],
    "oceanbase": [("CHAR(300)", "VARCHAR(300)"), ("STRING", "TEXT"), ("BYTES", "LONGBLOB"), ("TIMESTAMP(3)", "DATETIME"), ("TIMESTAMP_LTZ(3)", "TIMESTAMP")],
    "elasticsearch": [("DECIMAL(5, 1)", "STRING"), ("DATE", "STRING"), ("INT", "INT"), ("BOOLEAN", "BOOLEAN")],
    "maxcompute": [("TIME(0)", "STRING"), ("CHAR(3)", "STRING"), ("TIMESTAMP(3)", "TIMESTAMP_NTZ"), ("TIMESTAMP_LTZ(3)", "TIMESTAMP")],
    "fluss": [("VARCHAR(9)", "STRING"), ("VARBINARY(9)", "BYTES"), ("INT", "INT")],
    "iceberg": [("INT", "INT"), ("DECIMAL(9, 2)", "DECIMAL(9, 2)"), ("TIMESTAMP(6)", "TIMESTAMP(6)")],
    "paimon": [("BIGINT", "BIGINT"), ("ARRAY<INT>", "ARRAY<INT>")],
    "hudi": [("STRING", "STRING"), ("DATE", "DATE")],
}


def rows_sql(columns: str, rows: list[tuple]) -> str:
    shown = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) t({columns})"


def typed(kind: str, dialects: dict, pairs: dict, read_type: object) -> None:
    for name, own in pairs.items():

        def run(spark: SparkSession, sf_dir: str, name: str = name, own: list = own) -> DataFrame:
            return listed(spark, [(a, str(dialects[name](read_type(a)))) for a, _ in own], "given string, becomes string")

        run.__name__ = f"{kind}_{name}"
        rule(rows_sql("given, becomes", own))(run)


typed("type_from", formats.SOURCE_DIALECTS, SOURCE_TYPES, str)
typed("type_to", formats.SINK_DIALECTS, SINK_TYPES, Type.parse)

#: The least common type of two types.
COMMON = [
    ("TINYINT", "BIGINT", "BIGINT"), ("INT", "FLOAT", "DOUBLE"), ("SMALLINT", "FLOAT", "FLOAT"), ("DECIMAL(10, 2)", "INT", "DECIMAL(12, 2)"), ("DECIMAL(10, 2)", "DECIMAL(5, 4)", "DECIMAL(12, 4)"), ("DECIMAL(10, 2)", "DOUBLE", "STRING"), ("DATE", "TIMESTAMP(0)", "TIMESTAMP(9)"),
    ("TIMESTAMP(3)", "TIMESTAMP_LTZ(6)", "TIMESTAMP_LTZ(6)"), ("BOOLEAN", "INT", "STRING"), ("INT NOT NULL", "INT", "INT"), ("INT NOT NULL", "BIGINT NOT NULL", "BIGINT NOT NULL"),
]


@rule(rows_sql("a, b, common", COMMON))
def least_common_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(spark, [(a, b, str(S.least_common_type(Type.parse(a), Type.parse(b)))) for a, b, _ in COMMON], "a string, b string, common string")


PEOPLE = TableId.parse("app.people")
BASE = Schema.of(("id", "BIGINT"), ("name", "STRING"), ("age", "INT"), keys=["id"])
CHANGES = {
    "add first": Change(PEOPLE, "add.column", added=((Column("x", Type("INT")), "FIRST", None),)),
    "add after": Change(PEOPLE, "add.column", added=((Column("x", Type("INT")), "AFTER", "id"),)),
    "alter": Change(PEOPLE, "alter.column.type", types=(("age", Type("BIGINT")),)),
    "drop": Change(PEOPLE, "drop.column", dropped=("name",)),
    "rename": Change(PEOPLE, "rename.column", renamed=(("id", "key"),)),
    "comment": Change(PEOPLE, "table.comment", comment="who"),
}


def described(schema: Schema) -> str:
    return ", ".join(f"{c.name} {c.type}" for c in schema.columns) + f" / {', '.join(schema.primary_keys)} / {schema.comment or ''}"


@rule(
    rows_sql(
        "change, becomes",
        [
            ("add first", "x INT, id BIGINT NOT NULL, name STRING, age INT / id / "), ("add after", "id BIGINT NOT NULL, x INT, name STRING, age INT / id / "), ("alter", "id BIGINT NOT NULL, name STRING, age BIGINT / id / "),
            ("drop", "id BIGINT NOT NULL, age INT / id / "), ("rename", "key BIGINT NOT NULL, name STRING, age INT / key / "), ("comment", "id BIGINT NOT NULL, name STRING, age INT / id / who"),
        ],
    )
)
def applied_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(spark, [(k, described(S.apply_change(BASE, c))) for k, c in CHANGES.items()], "change string, becomes string")


@rule(rows_sql("change, lenient", [("add first", "add.column"), ("add after", "add.column"), ("alter", "alter.column.type"), ("drop", ""), ("rename", "add.column, alter.column.type"), ("comment", "table.comment")]))
def lenient_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed(spark, [(k, ", ".join(x.kind for x in S.lenient(BASE, c))) for k, c in CHANGES.items()], "change string, lenient string")


@rule(rows_sql("change, before, after", [("add first", False, True), ("add after", False, True), ("alter", False, True), ("drop", False, True), ("rename", False, True), ("comment", False, False)]))
def redundant_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a change is redundant before it has been applied, and after."""
    return listed(spark, [(k, S.is_redundant(BASE, c), S.is_redundant(S.apply_change(BASE, c), c)) for k, c in CHANGES.items()], "change string, before boolean, after boolean")


OTHER = Schema.of(("id", "BIGINT"), ("age", "DOUBLE"), ("city", "STRING"), keys=["id"])


@rule(rows_sql("what, found", [("common", "id BIGINT NOT NULL, name STRING, age DOUBLE, city STRING / id / "), ("compatible", "True"), ("narrow", "False"), ("steps", "add.column, alter.column.type, drop.column")]))
def schemas_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = S.least_common_schema(BASE, OTHER)
    rows = [("common", described(both)), ("compatible", str(S.is_compatible(both, OTHER))), ("narrow", str(S.is_compatible(BASE, OTHER))), ("steps", ", ".join(c.kind for c in S.difference(PEOPLE, BASE, OTHER)))]
    return listed(spark, rows, "what string, found string")


@rule(
    rows_sql(
        "behavior, columns",
        [("LENIENT", "id, name, age, x"), ("EVOLVE", "x, id, age"), ("TRY_EVOLVE", "id, name, age"), ("IGNORE", "id, name, age"), ("EXCEPTION", "fails")],
    )
)
def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink's columns after a column came first and another was dropped; under TRY_EVOLVE with a sink that refuses."""

    def refuse(change: Change) -> None:
        if change.kind != "create.table":
            raise RuntimeError(change.kind)

    rows = []
    for name in ("LENIENT", "EVOLVE", "TRY_EVOLVE", "IGNORE", "EXCEPTION"):
        evolution = SchemaEvolution(name)
        try:
            for change in (Change(PEOPLE, "create.table", schema=BASE), CHANGES["add first"], CHANGES["drop"]):
                evolution.arrive(change, PEOPLE, refuse if name == "TRY_EVOLVE" else None)
            rows.append((name, ", ".join(evolution.registry.sinks[str(PEOPLE)].names)))
        except ValueError:
            rows.append((name, "fails"))
    return listed(spark, rows, "behavior string, columns string")


@rule(rows_sql("tags, kinds", [("column without drop", "add.column, alter.column.type, create.table, rename.column"), ("default", "add.column, alter.column.type, create.table, drop.column, rename.column, table.comment"), ("table", "create.table, drop.table, table.comment, truncate.table")]))
def accepted_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {"column without drop": (["column"], ["drop"]), "default": (None, None), "table": (["table"], [])}
    return listed(spark, [(k, ", ".join(sorted(S.accepted_kinds(*v)))) for k, v in given.items()], "tags string, kinds string")


@rule(rows_sql("wildcard, change, passes", [(True, "add first", "add.column BEFORE id"), (True, "drop", "drop.column"), (False, "add first", None), (False, "alter", "alter.column.type"), (False, "drop", None)]))
def changes_through_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = []
    for wild, name in ((True, "add first"), (True, "drop"), (False, "add first"), (False, "alter"), (False, "drop")):
        out = S.transformed_change(CHANGES[name], wild, ["id", "age"])
        rows.append((wild, name, out and out.kind + "".join(f" {w} {a}" for _, w, a in out.added)))
    return listed(spark, rows, "wildcard boolean, change string, passes string")


@rule(rows_sql("what, found", [("columns", "user_id BIGINT, event_id BIGINT, event_type STRING, value DOUBLE, loud STRING NOT NULL"), ("keys", "loud"), ("partitions", "event_type"), ("options", "a=1"), ("reads", "user_id, value"), ("rows", "0")]))
def planned_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, partition keys, options and types of a transform's output, though its filter lets nothing pass."""
    made_by = TransformRule("app.events", "*, UPPER(event_type) AS loud", "FALSE", primary_keys=("loud",), partition_keys=("event_type",), table_options={"a": "1"})
    made = Transform(made_by, TableId.parse("app.events"), EVENTS, user_changes(spark, sf_dir))
    out = made.output_schema()
    reads = referenced_columns(TransformRule("app.events", "user_id, value * 2 AS twice", "twice > 3"), EVENTS)
    columns = ", ".join(f"{c.name} {c.type}" for c in out.columns)
    rows = [("columns", columns.replace("user_id BIGINT NOT NULL", "user_id BIGINT")), ("keys", ", ".join(out.primary_keys)), ("partitions", ", ".join(out.partition_keys)), ("options", ", ".join(f"{k}={v}" for k, v in out.options.items())), ("reads", ", ".join(reads)), ("rows", str(made.run().limit(1).count()))]
    return listed(spark, rows, "what string, found string")


@query("SELECT CAST(NULL AS INTEGER) AS x, c_custkey, upper(c_mktsegment) AS c_mktsegment, CAST(c_acctbal AS VARCHAR) AS c_acctbal FROM (SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal FROM customer)")
def evolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table after a column came, one went and one changed its type."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.upper("c_mktsegment").alias("c_mktsegment"), F.col("c_acctbal").cast("decimal(12,2)"))
    table, old = TableId.parse("app.customer"), Schema.from_spark(rows.schema, ["c_custkey"])
    now = old
    for change in (
        Change(table, "add.column", added=((Column("x", Type("INT")), "FIRST", None),)), Change(table, "drop.column", dropped=("c_name",)), Change(table, "alter.column.type", types=(("c_acctbal", Type("STRING")),)),
    ):
        now = S.apply_change(now, change)
    return rows.select(coerced(F.struct("*"), old, now).alias("r")).select("r.*")


@query(
    CHANGES_SQL
    + """SELECT user_id AS key, event_id IS NULL AS gone, event_id FROM (SELECT user_id, CASE WHEN op <> 'DELETE' THEN event_id END AS event_id, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS n FROM changes) WHERE n = 1"""
)
def sink_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sinks by key write: each key's last state, or that it is gone."""
    from deltaloom.sinks.registry import states

    rows = states(user_changes(spark, sf_dir), EVENTS)
    return rows.select(F.col("user_id").alias("key"), (F.col("gone_") == 1).alias("gone"), "event_id")


# Definitions, projections, routes and user functions


transformed("leading_star", "region", r"\*, UPPER(r_name) AS loud", None, "SELECT r_regionkey, r_name, upper(r_name) AS loud FROM region")
transformed(
    "json_forms", "nation",
    "n_nationkey, CAST(PARSE_JSON('{\"a\": 1, \"a\": 2}', TRUE)['a'] AS STRING) AS last, TRY_PARSE_JSON('{\"a\": 1, \"a\": 2}') IS NULL AS twice, PARSE_JSON('') IS NULL AS empty, CAST(PARSE_JSON('[' || n_nationkey || ', 7]')[1] AS STRING) AS made", None,
    "SELECT n_nationkey, '2' AS last, true AS twice, true AS empty, CAST(n_nationkey AS VARCHAR) AS made FROM nation",
)


def refused(made: object, *given: object) -> bool:
    from deltaloom.exprs import ParseError

    try:
        made(*given)
    except (ValueError, ParseError):
        return True
    return False


PROJECTIONS = [
    ("o_custkey + 1 AS x", False), ("o_custkey + 1", True), ("o_custkey + 1 AS x, o_orderkey + 1 AS x", True), ("o_custkey + 1 AS __table_name__", True), ("nothing AS x", True), ("o_custkey AS o_custkey, *", False), ("UPPER(o_custkey, 1) AS x", True), ("CAST(o_custkey AS DATE) AS x", True),
]


@rule(rows_sql("projection, refused", PROJECTIONS))
def refused_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which projections planning refuses: an expression without a name, names twice or reserved, unknown columns."""
    from deltaloom.exprs import Compiler, compile_projection

    compiler = Compiler(spark, read(spark, sf_dir, "orders").schema)
    return listed(spark, [(p, refused(compile_projection, compiler, p, {"__table_name__"})) for p, _ in PROJECTIONS], "projection string, refused boolean")


ENDS = "source: {type: values}\nsink: {type: values}\n"
DEFINITIONS = [
    ("ends only", ENDS, False), ("no sink", "source: {type: values}", True), ("unknown part", ENDS + "more: 1", True), ("route as a mapping", ENDS + "route: {a: b}", True), ("transform without table", ENDS + "transform: [{projection: a}]", True),
    ("unknown behaviour", ENDS + "pipeline: {schema.change.behavior: SOMETIMES}", True), ("a short zone", ENDS + "pipeline: {local-time-zone: PST}", True), ("a region", ENDS + "pipeline: {local-time-zone: Europe/Rome}", False), ("an offset", ENDS + "pipeline: {local-time-zone: '+02:00'}", False),
    ("not YAML", "source: [", True),
]


@rule(rows_sql("name, refused", [(n, r) for n, _, r in DEFINITIONS]))
def refused_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from deltaloom.plans.definition import parse

    return listed(spark, [(n, refused(parse, text)) for n, text, _ in DEFINITIONS], "name string, refused boolean")


@rule(rows_sql("option, setting", [("name", "own"), ("parallelism", "4"), ("route-mode", "ALL_MATCH"), ("streaming", "False"), ("a", "1"), ("b", "2")]))
def merged_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults under the global settings under the definition's own, and a table's options by a delimiter of its own."""
    from deltaloom.operators.transform import options_of
    from deltaloom.plans.definition import parse

    found = parse(ENDS + "pipeline: {name: own, execution.runtime-mode: BATCH}", {"name": "global", "parallelism": 4})
    rows = [(k, str(found.config[k])) for k in ("name", "parallelism", "route-mode")] + [("streaming", str(found.streaming)), *options_of("a=1; b=2", ";").items()]
    return listed(spark, rows, "option string, setting string")


@rule(rows_sql("table_id, mode, sinks", [("db.t_1", "ALL_MATCH", "ods.every, copy.t_1"), ("db.t_2", "ALL_MATCH", "ods.every, db_t_2.x"), ("db.t_1", "FIRST_MATCH", "ods.every"), ("db.u", "ALL_MATCH", "db.u")]))
def route_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from deltaloom.operators import route

    rules = [route.RouteRule(r"db.t_\.*", "ods.every"), route.RouteRule("db.t_1", "copy.<>", "<>"), route.RouteRule("(db).(t_2)", "$1_$2.x")]
    asked = [("db.t_1", "ALL_MATCH"), ("db.t_2", "ALL_MATCH"), ("db.t_1", "FIRST_MATCH"), ("db.u", "ALL_MATCH")]
    return listed(spark, [(t, m, ", ".join(map(str, route.targets(TableId.parse(t), rules, m)))) for t, m in asked], "table_id string, mode string, sinks string")


@query(rows_sql("what, found", [("even", "True"), ("text key", "False"), ("sparse", "False"), ("rows", "8096"), ("first", "id >= 5 | id < 5"), ("texts", "k < 'o''x' | k >= 'o''x'")]))
def chunk_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys are split evenly, and the predicates of a partitioned read, the unbounded chunk first or last."""
    orders, customer = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    rows = [
        ("even", str(C.is_even(orders, "o_orderkey"))), ("text key", str(C.is_even(customer, "c_name"))), ("sparse", str(C.is_even(orders.select((F.col("o_orderkey") * 100_000).alias("k")), "k"))), ("rows", str(C.CHUNK_ROWS)),
        ("first", " | ".join(C.predicates([(None, 5), (5, None)], "id", True))), ("texts", " | ".join(C.predicates([(None, "o'x"), ("o'x", None)], "k"))),
    ]
    return listed(spark, rows, "what string, found string")


@query("SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS at, 'events' AS name FROM events")
def connector_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's own metadata column, read out of the changes' meta."""
    schema = Schema.of(("event_id", "BIGINT"), ("event_type", "STRING"), keys=["event_id"])
    rule = TransformRule("app.events", "event_id, op_ts AS at, __table_name__ AS name")
    return Transform(rule, TableId.parse("app.events"), schema, event_log(spark, sf_dir), metadata={"op_ts": "BIGINT"}).run().select("after.*")


@query(CHANGES_SQL + "SELECT CAST('t' AS VARCHAR) AS topic, 'app.public.events,' || user_id AS key, CAST(0 AS INTEGER) AS partition, CAST('events' AS VARCHAR) AS header FROM changes")
def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics by mapping, keys, the partition and the headers of messages."""
    table = TableId.parse("app.public.events")
    rows = formats.kafka_rows(narrow_changes(spark, sf_dir), table, ["user_id"], "canal-json", "csv", mapping={str(table): "t"}, headers=True)
    return rows.select("topic", "key", "partition", F.col("headers")[2]["value"].cast("string").alias("header"))


@query("SELECT c_custkey, c_custkey + 100 AS up, '> ' || c_name AS said FROM customer")
def user_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's function stands before a built-in one of its name; a local stand-in for a model."""
    from deltaloom.functions.udfs import registered
    from deltaloom.plans.definition import ModelDef

    own = {"upper": lambda c, types: c + 100} | registered((), (ModelDef("chat", "LocalChat", {"prompt": "> "}),))
    return transform_rows(read(spark, sf_dir, "customer"), "c_custkey, UPPER(c_custkey) AS up, CHAT(c_name) AS said", udfs=own)


@query("SELECT max_by(user_id, event_id) AS user_id, event_type, max(event_id) AS event_id FROM events GROUP BY event_type")
def rekeyed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transform's own primary key: the table it leaves holds the last row of each."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    schema, table = Schema.of(("user_id", "BIGINT"), ("event_type", "STRING"), ("event_id", "BIGINT"), keys=["event_id"]), TableId.parse("app.events")
    rule = TransformRule("app.events", "user_id, event_type, event_id", primary_keys=("event_type",))
    made = Transform(rule, table, schema, changelog.envelope(rows, seq=F.col("event_id")))
    return changelog.materialized(made.run(), made.output_schema().primary_keys)
