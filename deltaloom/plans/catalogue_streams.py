"""Queries that run whole streams over the driver's tables, and the SQL of what they must leave."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltaloom import package
from deltaloom.catalog import Change, Column, Schema, TableId, Type
from deltaloom.plans.catalogue import CHANGES_SQL, flat, query, read, user_changes
from deltaloom.plans.definition import parse
from deltaloom.sinks.registry import Files, open_sink
from deltaloom.sources import positions as P
from deltaloom.sources.registry import control_row
from deltaloom.sources.follow import Follower, TableOfFiles, follow
from deltaloom.streaming.normalize import ROCKSDB, normalized
from deltaloom.streaming.resolved import Resolver
from deltaloom.streaming.runtime import Runtime

ORDERS, CUSTOMERS = TableId.parse("shop.orders"), TableId.parse("shop.customer")


def events(rows: DataFrame, table: TableId, op: str, position: object, **after: object) -> DataFrame:
    """A log's events of one kind, (at, value), one for each of rows, with some columns changed in the row after."""
    before = F.struct(*[F.col(c) for c in rows.columns])
    now = F.struct(*[(after[c] if c in after else F.col(c)).alias(c) for c in rows.columns])
    source = F.struct(F.lit(table.schema).alias("db"), F.lit(table.table).alias("table"), F.expr(str(position)).cast("bigint").alias("pos"))
    sides = [now.alias("after")] if op == "c" else [before.alias("before")] if op == "d" else [before.alias("before"), now.alias("after")]
    event = F.to_json(F.struct(*sides, F.lit(op).alias("op"), F.expr(str(position)).alias("ts_ms"), source.alias("source")))
    return rows.select(F.expr(str(position)).cast("bigint").alias("at"), event.alias("value"))


def order_log(orders: DataFrame) -> DataFrame:
    """Every fifth order gets dearer, every seventh is deleted then, every eleventh comes again under a new key."""
    k = "o_orderkey"
    dearer = events(orders.where(f"{k} % 5 = 0"), ORDERS, "u", f"1 + {k}", o_totalprice=F.col("o_totalprice") * 2)
    gone = events(orders.where(f"{k} % 7 = 0"), ORDERS, "d", f"1000000000 + {k}")
    new = events(orders.where(f"{k} % 11 = 0"), ORDERS, "c", f"2000000000 + {k}", o_orderkey=-F.col(k) - 1)
    return dearer.unionByName(gone).unionByName(new)


def segmented(log: DataFrame, path: str, segments: int, turn: int = 0) -> None:
    """Writes a log, or its turn-th part, as segments whose names are in the order of its positions."""
    log.repartitionByRange(segments, "at").sortWithinPartitions("at").select("value").write.text(f"{path}-{turn}")
    jvm, conf = log.sparkSession.sparkContext._jvm, log.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    fs.mkdirs(folder)
    for found in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}-{turn}")):
        name = found.getPath().getName()
        if name.startswith("part-"):
            fs.rename(found.getPath(), jvm.org.apache.hadoop.fs.Path(f"{path}/{turn:04}-{name}"))


def follower_of(spark: SparkSession, root: str, size: int) -> tuple[Follower, object]:
    definition = parse(f"source: {{type: values}}\nsink: {{type: files, path: '{root}/sink'}}\npipeline: {{name: follow, schema.change.behavior: EVOLVE}}")
    sink = open_sink(spark, {"type": "files", "path": f"{root}/sink"})
    return Follower(spark, Runtime(spark, definition, sink, f"{root}/cp"), f"{root}/state", f"{root}/log", size), sink


def until_done(follower: Follower, root: str, **options: object) -> None:
    running = follow(follower, f"{root}/cp", interval="0 seconds", **options)
    try:
        running.processAllAvailable()
    finally:
        running.stop()


FOLLOWED = """SELECT CASE WHEN o_orderkey % 11 = 0 AND n = 1 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN n = 0 AND o_orderkey % 5 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
  FROM orders, range(2) t(n) WHERE CASE WHEN n = 0 THEN o_orderkey % 7 <> 0 ELSE o_orderkey % 11 = 0 END"""


@query(FOLLOWED)
def snapshot_then_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders read in chunks and then followed through four segments of a log, by one stream."""
    root = package.scratch(spark)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    segmented(order_log(orders), f"{root}/log", 4)
    follower, sink = follower_of(spark, root, 2000)
    follower.begin()
    follower.add(ORDERS, TableOfFiles(orders, "o_orderkey", ["o_orderkey"]), first=True)
    until_done(follower, root, chunks_per_batch=32, segments_per_batch=2)
    return sink.read(ORDERS)


@query(
    f"""SELECT 'customer' AS of, c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS amount FROM customer
    UNION ALL SELECT 'orders', o_orderkey, o_totalprice FROM ({FOLLOWED})"""
)
def table_added_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers join a stream that has followed orders half-way: a restart reads them in chunks beside the moving log."""
    root = package.scratch(spark)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    risen = events(customers.where("c_custkey % 3 = 0"), CUSTOMERS, "u", "1500000000 + c_custkey", c_acctbal=F.col("c_acctbal") + 1)
    log = order_log(orders).unionByName(risen)
    segmented(log.where("at < 1200000000"), f"{root}/log", 3)
    follower, _ = follower_of(spark, root, 2000)
    follower.begin()
    follower.add(ORDERS, TableOfFiles(orders, "o_orderkey", ["o_orderkey"]), first=True)
    until_done(follower, root, chunks_per_batch=32, segments_per_batch=1)
    segmented(log.where("at >= 1200000000"), f"{root}/log", 3, turn=1)
    again, sink = follower_of(spark, root, 500)
    again.begin()
    again.add(ORDERS, TableOfFiles(orders, "o_orderkey", ["o_orderkey"]))
    again.add(CUSTOMERS, TableOfFiles(customers, "c_custkey", ["c_custkey"]))
    until_done(again, root, chunks_per_batch=2, segments_per_batch=1)
    rows = sink.read(CUSTOMERS).select(F.lit("customer").alias("of"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    return rows.unionByName(sink.read(ORDERS).select(F.lit("orders").alias("of"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")))


NORMALIZED = CHANGES_SQL + """SELECT op, CAST(2 * seq AS BIGINT) AS seq, CASE WHEN op <> 'INSERT' THEN user_id END AS b_user_id, p_event_id AS b_event_id, p_type AS b_event_type, p_value AS b_value,
  CASE WHEN op <> 'DELETE' THEN user_id END AS a_user_id, CASE WHEN op <> 'DELETE' THEN event_id END AS a_event_id, CASE WHEN op <> 'DELETE' THEN event_type END AS a_event_type, CASE WHEN op <> 'DELETE' THEN value END AS a_value
  FROM changes"""


def user_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' changes as a log of upserts has them: no rows before, deletions with the key only, and every third said twice."""
    changes = user_changes(spark, sf_dir)
    gone, names = F.col("op") == "DELETE", changes.schema["before"].dataType.names
    key = F.struct(*[(F.col(f"before.{c}") if c == "user_id" else F.lit(None).cast(changes.schema["before"].dataType[c].dataType)).alias(c) for c in names])
    said = F.explode(F.when(F.coalesce(F.col("after.event_id"), F.lit(1)) % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("said")
    told = changes.select(F.when(gone, "DELETE").otherwise("REPLACE").alias("op"), F.when(gone, key).alias("before"), "after", "meta", "seq", said)
    return told.withColumn("seq", 2 * F.col("seq") + F.col("said")).drop("said")


@query(NORMALIZED)
def normalized_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(normalized(user_upserts(spark, sf_dir), ["user_id"]))


@query(NORMALIZED)
def normalized_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by keyed state: a stream over each user's first changes, and its restart over the others."""
    root = package.scratch(spark)
    upserts = user_upserts(spark, sf_dir)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        for part in ("seq < 8", "seq >= 8"):
            upserts.where(part).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(upserts.schema).parquet(f"{root}/in")
            writer = normalized(stream, ["user_id"]).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
            writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return flat(spark.read.parquet(f"{root}/out"))


# Positions that aren't one number: servers of a cluster by event_id, shards by user

SERVERS = "SELECT *, 's' || ((event_id // 700) % 3) AS server, event_id AS txn FROM events WHERE user_id % 50 <> 0"


def server_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").where("user_id % 50 <> 0")
    return rows.withColumns({"server": F.expr("concat('S', (event_id div 700) % 3)"), "txn": F.col("event_id")})


@query(
    f"""WITH l AS (SELECT DISTINCT server, txn FROM ({SERVERS})), r AS (SELECT server, txn, txn - row_number() OVER (PARTITION BY server ORDER BY txn) AS run FROM l)
    SELECT server, min(txn) AS low, max(txn) AS high FROM r GROUP BY server, run"""
)
def transactions_executed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.executed(server_log(spark, sf_dir), "server", "txn")


@query(
    f"""SELECT event_id, server FROM ({SERVERS}) WHERE NOT ((server = 's0' AND (txn BETWEEN 0 AND 4000 OR txn BETWEEN 4500 AND 7000)) OR (server = 's1' AND (txn BETWEEN 700 AND 799 OR txn BETWEEN 901 AND 8000)))"""
)
def transactions_to_come(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader still lacks after a failover, by the set it had on two servers, less what it lost."""
    known = P.Transactions.parse("s0:0-4000,s1:700-8000").union(P.Transactions.parse("S0:4500-7000")).minus(P.Transactions.parse("s1:800-900"))
    return P.to_come(server_log(spark, sf_dir), known, "server", "txn").select("event_id", F.lower("server").alias("server"))


@query("SELECT user_id, max(event_id) AS event_id, max_by(value, event_id) AS value FROM events GROUP BY user_id")
def shards_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shards of users in any order, of which one is split; what it repeats after its end is left out."""
    rows = read(spark, sf_dir, "events").select("user_id", "event_id", "value")
    later = (F.col("user_id") % 2 == 0) & (F.col("event_id") > 3000)
    shard = F.when(F.col("user_id") % 2 == 1, "80-").when(~later, "-80").when(F.col("user_id") % 4 == 0, "-40").otherwise("40-80")
    told = rows.select("*", shard.alias("shard"), F.when(later, F.col("event_id") - 3000).otherwise(F.col("event_id")).alias("position"))
    stale = rows.where(later).select("user_id", "event_id", (-F.col("value") - 1).alias("value"), F.lit("-80").alias("shard"), F.col("event_id").alias("position"))
    changes = [P.Reshard({"-80": 3000}, ("-40", "40-80"))]
    ordered = P.by_vector(told.unionByName(stale), "shard", "position", changes)
    return ordered.groupBy("user_id").agg(F.max_by(F.struct("event_id", "value"), "seq").alias("last")).select("user_id", "last.*")


@query(
    """WITH w AS (SELECT max(event_id) // 6 + 1 AS w FROM events)
    SELECT event_id, CAST(event_id // w + 2 AS BIGINT) AS batch FROM events, w WHERE event_id // w + 2 <= 6"""
)
def regions_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four regions' events, some a batch late and some twice; the last region promises a batch later than the others."""
    root = package.scratch(spark)
    rows = read(spark, sf_dir, "events").select(F.col("event_id").alias("commit"), "user_id")
    width = rows.agg(F.max("commit")).first()[0] // 6 + 1
    late = (F.col("user_id") % 7 == 0).cast("int")
    at = F.explode(F.when(F.col("user_id") % 11 == 0, F.array(late, F.lit(1))).otherwise(F.array(late)))
    rows = rows.select("commit", (F.col("user_id") % 4).alias("region"), F.lit(None).cast("bigint").alias("resolved"), at.alias("late")).withColumn("batch", F.expr(f"commit div {width}") + F.col("late"))
    promised = spark.range(28).selectExpr("cast(null as bigint) as commit", "id % 4 as region", f"(id div 4 - if(id % 4 = 3, 1, 0)) * {width} - 1 as resolved", "id div 4 as batch")
    log = rows.drop("late").unionByName(promised)
    resolver = Resolver(spark, f"{root}/state", 4, lambda changes, batch: changes.write.mode("overwrite").parquet(f"{root}/out/batch={batch}"))
    for number in range(7):
        resolver.batch(log.where(F.col("batch") == number).drop("batch"), number)
    return spark.read.parquet(f"{root}/out").select(F.col("commit").alias("event_id"), F.col("batch").cast("bigint").alias("batch"))


# A table that changes its schema in the middle, by behaviour


class NoDrops(Files):
    supported = Files.supported - {"drop.column"}


#: How a definition ends, and the sink.
BEHAVIORS = {
    "LENIENT": ("LENIENT", "", Files), "EVOLVE": ("EVOLVE", "", Files), "IGNORE": ("IGNORE", "", Files), "TRY_EVOLVE": ("TRY_EVOLVE", "", NoDrops),
    "NO_DROPS": ("EVOLVE", ", exclude.schema.changes: [drop.column]", Files),
}


@query(
    """WITH c AS (SELECT *, c_custkey % 3 = 0 AS later FROM customer), b AS (SELECT unnest(['LENIENT', 'EVOLVE', 'IGNORE', 'TRY_EVOLVE', 'NO_DROPS']) AS behavior)
    SELECT behavior, c_custkey, CASE behavior WHEN 'LENIENT' THEN 'c_custkey c_name c_segment c_nationkey segment' WHEN 'EVOLVE' THEN 'c_custkey c_nationkey segment' WHEN 'IGNORE' THEN 'c_custkey c_name c_segment' ELSE 'c_custkey c_nationkey c_name segment' END AS columns,
      CASE WHEN NOT later AND behavior <> 'EVOLVE' THEN c_name END AS c_name, CASE WHEN later AND behavior <> 'IGNORE' THEN c_nationkey END AS c_nationkey,
      CASE WHEN later AND behavior <> 'IGNORE' OR NOT later AND behavior NOT IN ('LENIENT', 'IGNORE') THEN c_mktsegment END AS segment, CASE WHEN NOT later AND behavior IN ('LENIENT', 'IGNORE') THEN c_mktsegment END AS c_segment
    FROM c, b"""
)
def evolved_by_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through a stream in which, before the last third, a column comes, one goes and one changes its name."""
    root, table = package.scratch(spark), TableId.parse("shop.customer")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("c_segment"), "c_nationkey")
    nation = Type("BIGINT") if dict(customers.dtypes)["c_nationkey"] == "bigint" else Type("INT")
    old = Schema.of(("c_custkey", "BIGINT"), ("c_name", "STRING"), ("c_segment", "STRING"), keys=["c_custkey"])
    steps = [
        Change(table, "create.table", schema=old), Change(table, "add.column", added=((Column("c_nationkey", nation), "AFTER", "c_custkey"),)), Change(table, "drop.column", dropped=("c_name",)),
        Change(table, "rename.column", renamed=(("c_segment", "segment"),)),
    ]
    told = spark.createDataFrame([(str(table), 0 if i == 0 else 10 + i, "schema", control_row(s)) for i, s in enumerate(steps)], "table_id string, seq bigint, kind string, payload string")
    later = F.col("c_custkey") % 3 == 0
    row = F.when(later, F.to_json(F.struct("c_custkey", "c_nationkey", F.col("c_segment").alias("segment")))).otherwise(F.to_json(F.struct("c_custkey", "c_name", "c_segment")))
    payload = F.concat(F.lit('{"op":"INSERT","after":'), row, F.lit("}"))
    rows = customers.select(F.lit(str(table)).alias("table_id"), F.when(later, 20).otherwise(5).cast("bigint").alias("seq"), F.lit("data").alias("kind"), payload.alias("payload")).unionByName(told)
    out = None
    for name, (behavior, more, kind) in BEHAVIORS.items():
        definition = parse(f"source: {{type: values}}\nsink: {{type: files{more}}}\npipeline: {{name: evolve, schema.change.behavior: {behavior}}}")
        sink = kind(spark, {"path": f"{root}/{name}"})
        Runtime(spark, definition, sink, f"{root}/cp-{name}").batch(rows, 0)
        found = sink.read(table)
        own = [F.col(c) if c in found.columns else F.lit(None).cast(t).alias(c) for c, t in (("c_name", "string"), ("c_nationkey", "bigint"), ("segment", "string"), ("c_segment", "string"))]
        found = found.select(F.lit(name).alias("behavior"), "c_custkey", F.lit(" ".join(found.columns)).alias("columns"), *own)
        out = found if out is None else out.unionByName(found)
    return out


@query("SELECT DISTINCT o_custkey, CAST(1 AS BIGINT) AS buckets, true AS placed FROM orders")
def sink_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dealt to a sink's buckets: each customer's lie in one, and each bucket in the task of its number."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    made = open_sink(spark, {"type": "fluss", "bucket.key": "shop.orders:o_custkey;shop.others:x", "bucket.num": "shop.orders:6"})
    dealt = made.dealt(ORDERS, orders, Schema.from_spark(orders.schema, ["o_orderkey", "o_custkey"]))
    placed = (F.spark_partition_id() == F.col("bucket")) & F.col("bucket").between(0, 5)
    return dealt.withColumn("placed", placed).groupBy("o_custkey").agg(F.count_distinct("bucket").alias("buckets"), F.bool_and("placed").alias("placed"))
