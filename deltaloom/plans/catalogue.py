"""The query catalogue over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom.catalog import Schema, TableId
from deltaloom.functions.udfs import scalar
from deltaloom.operators import changelog, route
from deltaloom.operators.evolve import coerced
from deltaloom.operators.transform import Transform, TransformRule, transform_rows
from deltaloom.sinks import formats
from deltaloom.sources import chunks as C

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    def add(made: Callable) -> Callable:
        QUERIES[made.__name__], ORACLES[made.__name__] = made, sql
        return made

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transformed(name: str, table: str, projection: str, filter: str | None, sql: str) -> None:
    """A query that is one transform over one table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return transform_rows(read(spark, sf_dir, table), projection, filter)

    QUERIES[name], ORACLES[name] = run, sql


transformed(
    "projection_computed", "orders",
    "o_orderkey, UPPER(o_orderpriority) AS priority, o_totalprice * 2 AS double_price, o_custkey + 1 AS next_cust, o_orderkey % 7 AS o_custkey", None,
    "SELECT o_orderkey, upper(o_orderpriority) AS priority, o_totalprice * 2 AS double_price, o_custkey + 1 AS next_cust, o_orderkey % 7 AS o_custkey FROM orders",
)
transformed(
    "filter_computed", "orders", "o_orderkey, o_totalprice * 1.5e0 AS price, NULLIF(o_orderstatus, 'F') AS status", "price > 100000 AND status <> 'P'",
    "SELECT o_orderkey, o_totalprice * 1.5e0 AS price, nullif(o_orderstatus, 'F') AS status FROM orders WHERE o_totalprice * 1.5e0 > 100000 AND NOT coalesce(nullif(o_orderstatus, 'F') = 'P', false)",
)
transformed(
    "wildcard_override", "customer", "*, UPPER(c_name) AS c_name, c_acctbal >= 0 AS solvent", None,
    "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment, coalesce(c_acctbal >= 0, false) AS solvent FROM customer",
)
transformed(
    "cmp_null", "orders",
    "o_orderkey, NULLIF(o_orderstatus, 'O') = 'F' AS eq, NULLIF(o_orderstatus, 'O') <> 'F' AS ne, NULLIF(o_orderkey % 5, 0) < 3 AS lt, NULLIF(o_orderkey % 5, 0) IS DISTINCT FROM 2 AS df, NULLIF(o_orderstatus, 'O') IS NULL AS isnull", None,
    """SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'O') = 'F', false) AS eq, NOT coalesce(nullif(o_orderstatus, 'O') = 'F', false) AS ne,
       coalesce(nullif(o_orderkey % 5, 0) < 3, false) AS lt, nullif(o_orderkey % 5, 0) IS DISTINCT FROM 2 AS df, nullif(o_orderstatus, 'O') IS NULL AS isnull FROM orders""",
)
transformed(
    "between_in_null", "orders",
    "o_orderkey, NULLIF(o_orderkey % 10, 3) BETWEEN 2 AND 6 AS b, NULLIF(o_orderkey % 10, 3) NOT BETWEEN 2 AND 6 AS nb, NULLIF(o_orderkey % 10, 3) IN (1, 4, 9) AS i, NULLIF(o_orderkey % 10, 3) NOT IN (1, 4, 9) AS ni", None,
    """SELECT o_orderkey, coalesce(x BETWEEN 2 AND 6, false) AS b, NOT coalesce(x BETWEEN 2 AND 6, false) AS nb, coalesce(x IN (1, 4, 9), false) AS i, NOT coalesce(x IN (1, 4, 9), false) AS ni
       FROM (SELECT o_orderkey, nullif(o_orderkey % 10, 3) AS x FROM orders)""",
)
transformed(
    "logical_forms", "orders",
    "o_orderkey, (o_orderstatus = 'F') IS TRUE AS t, (o_orderstatus = 'F') IS NOT FALSE AS nf, NOT (o_orderstatus = 'F' OR o_totalprice > 150000) AS n, (o_orderstatus = 'F' AND o_orderkey % 2 = 0) IS NOT UNKNOWN AS k", None,
    """SELECT o_orderkey, coalesce(o_orderstatus = 'F', false) AS t, coalesce(o_orderstatus = 'F', false) AS nf, NOT (coalesce(o_orderstatus = 'F', false) OR coalesce(o_totalprice > 150000, false)) AS n, true AS k FROM orders""",
)
transformed(
    "like_regex", "documents", "doc_id, text LIKE '[0-9]{3}' AS digits, source LIKE 'src1%' ESCAPE '!' AS s1", "text LIKE '^[A-Z].*and'",
    "SELECT doc_id, regexp_matches(text, '[0-9]{3}') AS digits, source LIKE 'src1%' AS s1 FROM documents WHERE regexp_matches(text, '^[A-Z].*and')",
)
transformed(
    "similar_to", "part", "p_partkey, p_type SIMILAR TO '%(STEEL|TIN)' AS metal, p_brand SIMILAR TO 'Brand#[1-3]_' AS brand, p_name NOT SIMILAR TO '%a{2}%' AS plain", None,
    "SELECT p_partkey, regexp_full_match(p_type, '(?s:.*)(STEEL|TIN)') AS metal, regexp_full_match(p_brand, 'Brand#[1-3].') AS brand, NOT regexp_full_match(p_name, '(?s:.*)a{2}(?s:.*)') AS plain FROM part",
)
transformed(
    "regexp_family", "customer",
    "c_custkey, REGEXP_REPLACE(c_name, '0+', '$1') AS r, REGEXP_EXTRACT(c_name, '([A-Za-z]+)#', 1) AS x, REGEXP_EXTRACT(c_name, 'zz') AS none, REGEXP_COUNT(c_name, '0') AS n, REGEXP_SUBSTR(c_name, '[1-9][0-9]*') AS s, REGEXP_EXTRACT_ALL(c_name, '([1-9])')[1] AS a", None,
    """SELECT c_custkey, regexp_replace(c_name, '0+', '$1', 'g') AS r, CASE WHEN regexp_matches(c_name, '([A-Za-z]+)#') THEN regexp_extract(c_name, '([A-Za-z]+)#', 1) END AS x, CAST(NULL AS VARCHAR) AS none,
       CAST(len(regexp_extract_all(c_name, '0')) AS INTEGER) AS n, nullif(regexp_extract(c_name, '[1-9][0-9]*'), '') AS s, regexp_extract_all(c_name, '([1-9])', 1)[1] AS a FROM customer""",
)
transformed(
    "string_family", "customer",
    "c_custkey, c_name || ':' || NULLIF(c_mktsegment, 'BUILDING') AS cat, CONCAT_WS('-', c_mktsegment, c_name) AS ws, CHAR_LENGTH(c_name) AS len, LOWER(c_mktsegment) AS low, SUBSTRING(c_name, -3, 2) AS tail, SUBSTR(c_name, 0, 4) AS head, SUBSTRING(c_name, -99, 2) AS gone, POSITION('#' IN c_name) AS pos, LEFT(c_name, 3) AS l, RIGHT(c_name, 3) AS rr, REPEAT('ab', 2) AS rep, REPLACE(c_name, '#', '') AS repl", None,
    """SELECT c_custkey, c_name || ':' || coalesce(nullif(c_mktsegment, 'BUILDING'), 'null') AS cat, c_mktsegment || '-' || c_name AS ws, CAST(length(c_name) AS INTEGER) AS len, lower(c_mktsegment) AS low,
       substr(c_name, length(c_name) - 2, 2) AS tail, substr(c_name, 1, 4) AS head, '' AS gone, CAST(instr(c_name, '#') AS INTEGER) AS pos, left(c_name, 3) AS l, right(c_name, 3) AS rr, 'abab' AS rep, replace(c_name, '#', '') AS repl FROM customer""",
)
transformed(
    "trim_pad_family", "part",
    "p_partkey, TRIM('  ' || p_name || ' ') AS t, LTRIM(p_name, 'abc') AS lt, RTRIM(p_name, 'xyz') AS rt, BTRIM(p_brand, 'B1') AS bt, LPAD(p_brand, 12, '*') AS lp, RPAD(p_brand, 4, '*') AS rp, LPAD(p_brand, -1, '*') AS np, OVERLAY(p_brand PLACING 'xx' FROM 2 FOR 3) AS ov, STARTSWITH(p_name, 'a') AS sw, ENDSWITH(p_name, 'e') AS ew", None,
    """SELECT p_partkey, trim(p_name) AS t, ltrim(p_name, 'abc') AS lt, rtrim(p_name, 'xyz') AS rt, trim(p_brand, 'B1') AS bt, lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 4, '*') AS rp, CAST(NULL AS VARCHAR) AS np,
       substr(p_brand, 1, 1) || 'xx' || substr(p_brand, 5) AS ov, starts_with(p_name, 'a') AS sw, ends_with(p_name, 'e') AS ew FROM part""",
)
transformed(
    "base64_family", "customer", "c_custkey, TO_BASE64(c_name) AS b, FROM_BASE64(TO_BASE64(c_mktsegment)) AS f", None,
    "SELECT c_custkey, base64(encode(c_name)) AS b, c_mktsegment AS f FROM customer",
)
transformed(
    "arithmetic_forms", "lineitem",
    "l_orderkey, l_linenumber, l_linenumber / 2 AS int_div, l_orderkey / 7 AS big_div, l_linenumber % 3 AS rest, -l_linenumber AS neg, ABS(l_linenumber - 4) AS a, l_quantity / 4 AS real_div, FLOOR(l_extendedprice) AS f, CEIL(l_extendedprice) AS c, CAST(l_linenumber AS DECIMAL(10, 2)) * 3 AS d", None,
    """SELECT l_orderkey, l_linenumber, l_linenumber // 2 AS int_div, l_orderkey // 7 AS big_div, l_linenumber % 3 AS rest, -l_linenumber AS neg, abs(l_linenumber - 4) AS a, l_quantity / 4 AS real_div,
       floor(l_extendedprice) AS f, ceil(l_extendedprice) AS c, CAST(l_linenumber * 3 AS DECIMAL(19, 2)) AS d FROM lineitem""",
)
transformed(
    "cast_permissive", "lineitem",
    "l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS q, CAST(CAST(l_orderkey AS STRING) AS BIGINT) AS k, CAST(l_returnflag AS INT) AS junk, CAST(l_linenumber + 126 AS TINYINT) AS wrap, CAST('2.9' AS INT) AS cut, CAST(l_linenumber - 1 AS BOOLEAN) AS flag, CAST(l_linestatus AS BOOLEAN) AS no, CAST(l_linenumber AS DOUBLE) AS dd", None,
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS q, l_orderkey AS k, CAST(NULL AS INTEGER) AS junk, CAST((l_linenumber + 126 + 128) % 256 - 128 AS TINYINT) AS wrap, CAST(2 AS INTEGER) AS cut,
       l_linenumber <> 1 AS flag, false AS no, CAST(l_linenumber AS DOUBLE) AS dd FROM lineitem""",
)
transformed(
    "case_if_coalesce", "orders",
    "o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS s, CASE WHEN o_totalprice > 200000 THEN 2 WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS tier, IF(o_orderkey % 2 = 0, 'even', 'odd') AS parity, COALESCE(NULLIF(o_orderstatus, 'F'), 'f') AS c", None,
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS s, CASE WHEN o_totalprice > 200000 THEN 2 WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS tier,
       CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, coalesce(nullif(o_orderstatus, 'F'), 'f') AS c FROM orders""",
)
transformed(
    "temporal_extract", "orders",
    "o_orderkey, EXTRACT(YEAR FROM o_orderdate) AS y, QUARTER(o_orderdate) AS q, MONTH(o_orderdate) AS m, WEEK(o_orderdate) AS w, DAYOFYEAR(o_orderdate) AS doy, DAYOFMONTH(o_orderdate) AS d, DAYOFWEEK(o_orderdate) AS dow, HOUR(o_orderdate) AS h, EXTRACT(SECOND FROM o_orderdate) AS s", None,
    """SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, week(o_orderdate) AS w, dayofyear(o_orderdate) AS doy, day(o_orderdate) AS d, dayofweek(o_orderdate) + 1 AS dow,
       hour(o_orderdate) AS h, CAST(second(o_orderdate) AS BIGINT) AS s FROM orders""",
)
transformed(
    "temporal_add", "orders",
    "o_orderkey, TIMESTAMPADD(MONTH, 2, o_orderdate) AS m, TIMESTAMPADD(DAY, -3, o_orderdate) AS d, o_orderdate + INTERVAL '36' HOUR AS h, DATE_ADD(o_orderdate, 10) AS a, TO_DATE(o_orderdate) + INTERVAL '36' HOUR AS whole", None,
    """SELECT o_orderkey, o_orderdate + INTERVAL 2 MONTH AS m, o_orderdate - INTERVAL 3 DAY AS d, o_orderdate + INTERVAL 36 HOUR AS h, strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS a,
       CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY AS DATE) AS whole FROM orders""",
)
transformed(
    "temporal_diff", "orders",
    "o_orderkey, TIMESTAMPDIFF(MONTH, TO_TIMESTAMP('1995-01-31 00:00:00'), o_orderdate) AS m, TIMESTAMPDIFF(YEAR, TO_TIMESTAMP('1995-01-31 00:00:00'), o_orderdate) AS y, TIMESTAMPDIFF(DAY, TO_TIMESTAMP('1990-01-01 12:00:00'), o_orderdate) AS d", None,
    """SELECT o_orderkey, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS INTEGER) AS m, CAST(year(o_orderdate) - 1995 AS INTEGER) AS y,
       CAST((epoch(o_orderdate)::BIGINT - epoch(TIMESTAMP '1990-01-01 12:00:00')::BIGINT) // 86400 AS INTEGER) AS d FROM orders""",
)
transformed(
    "date_formats", "orders",
    "o_orderkey, DATE_FORMAT(o_orderdate, 'yyyy/MM/dd HH:mm') AS f, FROM_UNIXTIME(o_orderkey * 1000, 'yyyy-MM-dd HH:mm:ss') AS u, UNIX_TIMESTAMP('nonsense', 'yyyy-MM-dd') AS junk, TO_DATE('1999-13-01') AS none, CAST(TO_DATE('1999-12-01') AS STRING) AS day", None,
    """SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d %H:%M') AS f, strftime(make_timestamp(o_orderkey * 1000 * 1000000), '%Y-%m-%d %H:%M:%S') AS u, CAST(-9223372036854775808 AS BIGINT) AS junk, CAST(NULL AS DATE) AS none, '1999-12-01' AS day FROM orders""",
)
transformed(
    "json_variant", "events", "event_id, CAST(PARSE_JSON(props)['k'] AS STRING) AS k, TRY_PARSE_JSON('{oops') IS NULL AS bad, CAST(PARSE_JSON('[1, [2, 3]]')[2][1] AS STRING) AS two", None,
    "SELECT event_id, json_extract_string(props, '$.k') AS k, true AS bad, '2' AS two FROM events",
)


# Changelogs, derived from events: a user's first event inserts, later ones update, a last 'error' deletes

CHANGES_SQL = """
WITH placed AS (
  SELECT *, lag(event_id) OVER w AS p_event_id, lag(event_type) OVER w AS p_type, lag(value) OVER w AS p_value, row_number() OVER w AS seq, lead(1) OVER w IS NULL AS final
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
changes AS (
  SELECT user_id, event_id, event_type, value, p_event_id, p_type, p_value, seq,
    CASE WHEN p_event_id IS NULL THEN 'INSERT' WHEN final AND event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op FROM placed)
"""


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    made = changelog.derived(rows, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error")
    narrow = lambda s: F.when(F.col(s).isNotNull(), F.struct(*[F.col(f"{s}.{c}").alias(c) for c in ("user_id", "event_id", "event_type", "value")])).alias(s)
    return made.select("op", narrow("before"), narrow("after"), "meta", "seq")


EVENTS = Schema.of(("user_id", "BIGINT"), ("event_id", "BIGINT"), ("event_type", "STRING"), ("value", "DOUBLE"), keys=["user_id"])


def flat(changes: DataFrame) -> DataFrame:
    """A changelog with its sides side by side."""
    names = changes.schema["after"].dataType.names
    return changes.select("op", "seq", *[F.col(f"before.`{n}`").alias(f"b_{n}") for n in names], *[F.col(f"after.`{n}`").alias(f"a_{n}") for n in names])


@query(CHANGES_SQL + "SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS n FROM changes) WHERE n = 1 AND op <> 'DELETE'")
def materialize_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.materialized(user_changes(spark, sf_dir), ["user_id"])


@query("SELECT user_id, max_by(event_id, ts) AS event_id, max_by(value, ts) AS value FROM (SELECT user_id, event_id, value, (ts, event_id) AS ts FROM events) GROUP BY user_id")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "value", F.struct("ts", "event_id").alias("at"))
    return rows.groupBy("user_id").agg(F.max_by(F.struct("event_id", "value"), "at").alias("last")).select("user_id", "last.*")


@query(
    CHANGES_SQL
    + """SELECT 'INSERT' AS op, CAST(seq AS BIGINT) AS seq, user_id, event_id, event_type, value FROM changes WHERE op <> 'DELETE'
    UNION ALL SELECT 'INSERT', CAST(seq AS BIGINT), user_id, p_event_id, p_type, p_value FROM changes WHERE op <> 'INSERT'"""
)
def append_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.append_only(user_changes(spark, sf_dir)).select("op", "seq", "after.*")


@query(
    CHANGES_SQL
    + """SELECT CASE op WHEN 'INSERT' THEN '+I' ELSE '+U' END AS row_kind, CAST(seq AS BIGINT) AS seq, user_id, event_id, event_type, value FROM changes WHERE op <> 'DELETE'
    UNION ALL SELECT CASE op WHEN 'UPDATE' THEN '-U' ELSE '-D' END, CAST(seq AS BIGINT), user_id, p_event_id, p_type, p_value FROM changes WHERE op <> 'INSERT'"""
)
def changelog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.exploded(user_changes(spark, sf_dir)).select("row_kind", "seq", "user_id", "event_id", "event_type", "value")


def ruled(spark: SparkSession, sf_dir: str, **rule: object) -> DataFrame:
    return Transform(TransformRule("app.public.events", **rule), TableId.parse("app.public.events"), EVENTS, user_changes(spark, sf_dir)).run()


@query(
    CHANGES_SQL
    + """SELECT * FROM (SELECT CASE WHEN op <> 'UPDATE' THEN op WHEN b AND a THEN 'UPDATE' WHEN b THEN 'DELETE' ELSE 'INSERT' END AS op, CAST(seq AS BIGINT) AS seq,
      CASE WHEN b THEN user_id END AS b_user_id, CASE WHEN b THEN p_value * 2 END AS b_twice, CASE WHEN a THEN user_id END AS a_user_id, CASE WHEN a THEN value * 2 END AS a_twice
      FROM (SELECT *, op <> 'INSERT' AND coalesce(p_value * 2 > 60, false) AS b, op <> 'DELETE' AND coalesce(value * 2 > 60, false) AS a FROM changes) WHERE a OR b)"""
)
def filter_update_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ruled(spark, sf_dir, projection="user_id, value * 2 AS twice", filter="twice > 60"))


@query(
    CHANGES_SQL
    + """SELECT op, CAST(seq AS BIGINT) AS seq, CASE WHEN op <> 'INSERT' THEN user_id END AS b_user_id, CASE WHEN op <> 'INSERT' THEN 'app.public.events' END AS b_id, CASE op WHEN 'UPDATE' THEN '-U' WHEN 'DELETE' THEN '-D' END AS b_kind,
      CASE WHEN op <> 'DELETE' THEN user_id END AS a_user_id, CASE WHEN op <> 'DELETE' THEN 'app.public.events' END AS a_id, CASE op WHEN 'UPDATE' THEN '+U' WHEN 'INSERT' THEN '+I' END AS a_kind FROM changes"""
)
def metadata_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ruled(spark, sf_dir, projection="user_id, __namespace_name__ || '.' || __schema_name__ || '.' || __table_name__ AS id, __data_event_type__ AS kind"))


@query(
    CHANGES_SQL
    + """SELECT CASE op WHEN 'DELETE' THEN 'INSERT' ELSE op END AS op, CAST(seq AS BIGINT) AS seq, CASE op WHEN 'UPDATE' THEN user_id END AS b_user_id, CASE op WHEN 'UPDATE' THEN p_event_id END AS b_event_id, CASE op WHEN 'UPDATE' THEN '-U' END AS b_kind,
      user_id AS a_user_id, CASE op WHEN 'DELETE' THEN p_event_id ELSE event_id END AS a_event_id, CASE op WHEN 'UPDATE' THEN '+U' WHEN 'INSERT' THEN '+I' ELSE '-D' END AS a_kind FROM changes"""
)
def soft_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ruled(spark, sf_dir, projection="user_id, event_id, __data_event_type__ AS kind", converter="SOFT_DELETE"))


# Routes


@query("SELECT 'ods.orders_all' AS table_id, o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')")
def route_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    tables = {TableId.parse(f"app.orders_{s.lower()}"): orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")}
    rules = [route.RouteRule(r"app.orders_\.*", "ods.orders_all")]
    (sink, sources), *_ = route.routed(tables, rules).items()
    schemas = {t: Schema.from_spark(f.schema, ["o_orderkey"]) for t, f in tables.items()}
    merged, _ = route.merged({t: changelog.envelope(tables[t]) for t in sources}, schemas, sink)
    return merged.select("table_id", "after.*")


@query("SELECT t AS table_id, o_orderkey, o_totalprice FROM orders, (VALUES ('backup.orders'), ('ods.orders')) v(t)")
def route_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, table = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), TableId.parse("app.orders")
    rules = [route.RouteRule("app.orders", "ods.orders"), route.RouteRule("(app).(orders)", "backup.$2")]
    sinks = route.targets(table, rules)
    return orders.select(F.explode(F.array(*[F.lit(str(s)) for s in sinks])).alias("table_id"), "o_orderkey", "o_totalprice")


@query("SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderstatus, NULL::VARCHAR AS o_orderpriority FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT CAST(o_orderkey AS BIGINT), CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE), NULL, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1")
def shard_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    even = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("int"), "o_totalprice", "o_orderstatus")
    odd = orders.where("o_orderkey % 2 = 1").select("o_orderkey", F.col("o_totalprice").cast("float"), "o_orderpriority")
    return route.merged_rows({"even": even, "odd": odd})


# Snapshots


@query(
    """WITH b AS (SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders), c AS (SELECT a, greatest((b - a - 1) // 500 + 1, 0) AS last, unnest(range(0, CAST(greatest((b - a - 1) // 500 + 1, 0) + 1 AS BIGINT))) AS chunk_id FROM b)
    SELECT chunk_id, CASE WHEN chunk_id > 0 THEN a + chunk_id * 500 END AS low, CASE WHEN chunk_id < last THEN a + (chunk_id + 1) * 500 END AS high FROM c"""
)
def chunk_split_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.even_chunks(read(spark, sf_dir, "orders"), "o_orderkey", 500)


@query(
    """WITH r AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS rank FROM (SELECT DISTINCT c_name FROM customer)), l AS (SELECT c_name AS low FROM r WHERE rank > 0 AND rank % 100 = 0 UNION ALL SELECT NULL)
    SELECT row_number() OVER (ORDER BY low NULLS FIRST) - 1 AS chunk_id, low, lead(low) OVER (ORDER BY low NULLS FIRST) AS high FROM l"""
)
def chunk_split_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.uneven_chunks(read(spark, sf_dir, "customer"), "c_name", 100)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 2"""
)
def backfill_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot with a log in which one in four orders was updated, one deleted, and later changes lie past the mark."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    row, changed = F.struct("o_orderkey", "o_orderstatus", "o_totalprice"), F.struct("o_orderkey", F.lit("X").alias("o_orderstatus"), "o_totalprice")
    updates = orders.where("o_orderkey % 4 = 1").select(F.lit("UPDATE").alias("op"), row.alias("before"), changed.alias("after"), F.lit(10).cast("bigint").alias("seq"))
    deletes = orders.where("o_orderkey % 4 = 2").select(F.lit("DELETE").alias("op"), row.alias("before"), F.lit(None).cast(updates.schema["after"].dataType).alias("after"), F.lit(20).cast("bigint").alias("seq"))
    later = orders.where("o_orderkey % 4 = 3").select(F.lit("DELETE").alias("op"), row.alias("before"), F.lit(None).cast(updates.schema["after"].dataType).alias("after"), F.lit(99).cast("bigint").alias("seq"))
    return C.backfilled(orders, updates.unionByName(deletes).unionByName(later), ["o_orderkey"], 5, 50)


FLAT_SQL = CHANGES_SQL + """SELECT op, CAST(seq AS BIGINT) AS seq,
  CASE WHEN op <> 'INSERT' THEN user_id END AS b_user_id, CASE WHEN op <> 'INSERT' THEN p_event_id END AS b_event_id, CASE WHEN op <> 'INSERT' THEN p_type END AS b_event_type, CASE WHEN op <> 'INSERT' THEN p_value END AS b_value,
  CASE WHEN op <> 'DELETE' THEN user_id END AS a_user_id, CASE WHEN op <> 'DELETE' THEN event_id END AS a_event_id, CASE WHEN op <> 'DELETE' THEN event_type END AS a_event_type, CASE WHEN op <> 'DELETE' THEN value END AS a_value FROM changes"""


@query(FLAT_SQL)
def partition_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(changelog.partitioned(user_changes(spark, sf_dir), "PRIMARY_KEY", ["user_id"]))


@query(
    """SELECT o.o_orderkey, o.o_totalprice, c.c_name, n.n_name FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""
)
def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host SQL over materialized tables; Spark broadcasts a side only below its own size threshold."""
    orders, customer, nation = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left").join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    return joined.select("o_orderkey", "o_totalprice", "c_name", "n_name")


transformed(
    "interval_compound", "orders", "o_orderkey, o_orderdate + INTERVAL '1 02:03:04' DAY TO SECOND AS a, o_orderdate - INTERVAL '1-2' YEAR TO MONTH AS b, TIMESTAMPADD(WEEK, 2, o_orderdate) AS c", "o_orderdate + INTERVAL '1' DAY > TO_TIMESTAMP('1995-06-01 00:00:00')",
    "SELECT o_orderkey, o_orderdate + INTERVAL '1 day 02:03:04' AS a, o_orderdate - INTERVAL 14 MONTH AS b, o_orderdate + INTERVAL 14 DAY AS c FROM orders WHERE o_orderdate + INTERVAL 1 DAY > TIMESTAMP '1995-06-01 00:00:00'",
)
transformed(
    "array_access", "embeddings", "vec_id, embedding[1] AS first, embedding[vec_id % 3 + 1] AS some, embedding[0] AS none, embedding[9999] AS gone", None,
    "SELECT vec_id, embedding[1] AS first, embedding[vec_id % 3 + 1] AS some, CAST(NULL AS FLOAT) AS none, CAST(NULL AS FLOAT) AS gone FROM embeddings",
)
transformed(
    "short_circuit", "orders", "o_orderkey, o_orderkey % 3 = 0 OR 7 / (o_orderkey % 3) > 3 AS a", "NOT (o_orderkey % 2 = 0 AND 5 / (o_orderkey % 2 + 1) = 4)",
    "SELECT o_orderkey, o_orderkey % 3 = 0 OR 7 // nullif(o_orderkey % 3, 0) > 3 AS a FROM orders WHERE NOT (o_orderkey % 2 = 0 AND 5 // (o_orderkey % 2 + 1) = 4)",
)


@query(
    CHANGES_SQL
    + """SELECT op, CAST(seq AS BIGINT) AS seq, CASE op WHEN 'DELETE' THEN user_id END AS b_user_id, CASE op WHEN 'DELETE' THEN p_event_id END AS b_event_id, CASE op WHEN 'DELETE' THEN p_type END AS b_event_type, CASE op WHEN 'DELETE' THEN p_value END AS b_value,
      CASE WHEN op <> 'DELETE' THEN user_id END AS a_user_id, CASE WHEN op <> 'DELETE' THEN event_id END AS a_event_id, CASE WHEN op <> 'DELETE' THEN event_type END AS a_event_type, CASE WHEN op <> 'DELETE' THEN value END AS a_value FROM changes"""
)
def upsert_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(changelog.upserts(user_changes(spark, sf_dir)))


@query(CHANGES_SQL + "SELECT op, CAST(seq AS BIGINT) AS seq, CASE WHEN op <> 'DELETE' THEN event_id END AS event_id FROM changes WHERE seq >= 5")
def startup_specific_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.started(user_changes(spark, sf_dir), "specific-offset", 5).select("op", "seq", "after.event_id")


@query("SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'ods.even_copy' ELSE 'ods.app_odd' END AS table_id, o_orderkey FROM orders")
def route_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace symbol, and capture groups under FIRST_MATCH."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey")
    rules = [route.RouteRule("app.even", "ods.<>_copy", "<>"), route.RouteRule(r"(app).(\.*)", "ods.$1_$2"), route.RouteRule(r"app.\.*", "never.seen")]
    out = None
    for name, rest in (("even", 0), ("odd", 1)):
        for sink in route.targets(TableId.parse(f"app.{name}"), rules, "FIRST_MATCH"):
            one = orders.where(F.col("o_orderkey") % 2 == rest).select(F.lit(str(sink)).alias("table_id"), "o_orderkey")
            out = one if out is None else out.unionByName(one)
    return out


SIDES_SQL = """CASE WHEN op <> 'INSERT' THEN {'user_id': user_id, 'event_id': p_event_id, 'event_type': p_type} END AS b, CASE WHEN op <> 'DELETE' THEN {'user_id': user_id, 'event_id': event_id, 'event_type': event_type} END AS a"""


def narrow_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ruled(spark, sf_dir, projection="user_id, event_id, event_type")


@query(
    CHANGES_SQL
    + f"""SELECT CAST(seq AS BIGINT) AS seq, CAST(to_json({{'before': b, 'after': a, 'op': CASE op WHEN 'INSERT' THEN 'c' WHEN 'UPDATE' THEN 'u' ELSE 'd' END, 'source': {{'db': 'public', 'table': 'events'}}}}) AS VARCHAR) AS value,
      'app.public.events,' || user_id AS key FROM (SELECT *, {SIDES_SQL} FROM changes)"""
)
def debezium_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TableId.parse("app.public.events")
    return formats.message_key(formats.debezium_json(narrow_changes(spark, sf_dir), table), table, ["user_id"], "csv").select("seq", "key", "value")


@query(
    CHANGES_SQL
    + f"""SELECT CAST(seq AS BIGINT) AS seq, CAST(to_json({{'old': CASE op WHEN 'UPDATE' THEN [b] END, 'data': [CASE op WHEN 'DELETE' THEN b ELSE a END], 'type': op, 'database': 'public', 'table': 'events', 'pkNames': ['user_id']}}) AS VARCHAR) AS value
      FROM (SELECT *, {SIDES_SQL} FROM changes)"""
)
def canal_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formats.canal_json(narrow_changes(spark, sf_dir), TableId.parse("app.public.events"), ["user_id"]).select("seq", "value")


@query("SELECT CAST(floor((o_orderkey - (SELECT min(o_orderkey) FROM orders)) / 500) AS BIGINT) AS chunk_id, count(*) AS n FROM orders GROUP BY 1")
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    low = orders.agg(F.min("o_orderkey").alias("low"))  # one row
    return orders.crossJoin(F.broadcast(low)).groupBy(C.even_chunk_of(F.col("o_orderkey"), F.col("low"), 500).alias("chunk_id")).agg(F.count(F.lit(1)).alias("n"))


@query(CHANGES_SQL + "SELECT op, CAST(seq AS BIGINT) AS seq, user_id FROM changes WHERE seq > CASE WHEN user_id < 50 THEN 10 WHEN user_id < 90 THEN 20 ELSE 30 END")
def log_after_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the log once each chunk's own high mark has been read."""
    marks = spark.createDataFrame([(None, 50, 10), (50, 90, 20), (90, None, 30)], "low bigint, high bigint, high_mark bigint")
    return C.after_snapshot(user_changes(spark, sf_dir), marks, "user_id").select("op", "seq", F.coalesce("after.user_id", "before.user_id").alias("user_id"))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def skip_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay that repeats each third row's update still leaves the table as it is."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    row = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    again = orders.where("o_orderkey % 3 = 0").select(F.lit("UPDATE").alias("op"), row.alias("before"), row.alias("after"), F.lit(1).cast("bigint").alias("seq"))
    return changelog.materialized(C.replayed(orders, again), ["o_orderkey"])


@query("SELECT c_custkey, c_name || '!' AS loud, c_custkey + 7 AS more FROM customer")
def user_defined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class's overloads, in Arrow batches."""
    return transform_rows(read(spark, sf_dir, "customer"), "c_custkey, shift(c_name) AS loud, SHIFT(c_custkey) AS more", udfs={"shift": scalar(Shift, {"n": "7"})})


class Shift:
    def open(self, options: dict) -> None:
        self.n = int(options["n"])

    def eval(self, x: int) -> int:
        return None if x is None else x + self.n

    def eval_text(self, x: str) -> str:
        return None if x is None else x + "!"


@query("SELECT o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(NULL AS DATE) AS extra, CAST(o_custkey AS DOUBLE) AS o_custkey FROM (SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice FROM orders)")
def coerced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(12,2)"))
    target = Schema.of(("o_orderkey", "BIGINT"), ("o_totalprice", "STRING"), ("extra", "DATE"), ("o_custkey", "DOUBLE"))
    return orders.select(coerced(F.struct("*"), Schema.from_spark(orders.schema), target).alias("r")).select("r.*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from deltaloom.plans import catalogue_rules, catalogue_streams  # noqa: F401  register their own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(ORACLES)
