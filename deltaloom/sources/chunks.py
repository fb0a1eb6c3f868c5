"""Snapshots in chunks: how a table is split by a key, read consistently with its log, and followed from there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.operators.changelog import materialized

CHUNK_ROWS = 8096
#: Chunk bounds that one task numbers.
GROUP = 1 << 16
#: Ranges of keys in which a log's changes look for their chunks, and the least number of tasks that share a range: where
#: there are fewer ranges, as many as make CELLS in all.
CELLS, SHARED = 256, 8
#: Rows per step of keys within which a numeric key counts as even.
FACTOR_LOW, FACTOR_HIGH = 0.05, 1000.0


def distribution_factor(low: float, high: float, count: int) -> float:
    return (high - low + 1) / count if count else 0.0


def even_chunks(rows: DataFrame, key: str, step: int) -> DataFrame:
    """Chunks of a numeric key by fixed steps from its minimum, [low, high) with open ends: (chunk_id, low, high), the
    last, unbounded above, first if a reader takes them in this order. One pass over the key for its bounds."""
    bounds = rows.agg(F.min(key).cast("bigint").alias("a"), F.max(key).cast("bigint").alias("b"))
    last = F.call_function("div", F.col("b") - F.col("a") - 1 + F.lit(0), F.lit(step).cast("bigint")) + 1
    ids = bounds.where("a is not null").select("a", "b", F.greatest(last, F.lit(0)).alias("last")).select("a", "last", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("chunk_id"))
    return ids.select(
        "chunk_id",
        F.when(F.col("chunk_id") > 0, F.col("a") + F.col("chunk_id") * step).alias("low"),
        F.when(F.col("chunk_id") < F.col("last"), F.col("a") + (F.col("chunk_id") + 1) * step).alias("high"),
    )


def even_chunk_of(key: Column, low: Column, step: int) -> Column:
    """The chunk of a key under even_chunks, low being the least key."""
    return F.floor((key - low) / step).cast("bigint")


def uneven_chunks(rows: DataFrame, key: str, size: int = CHUNK_ROWS) -> DataFrame:
    """Chunks of any ordered key with size rows each: (chunk_id, low, high).

    Keys are range-partitioned and sorted once; a partition's first rank comes from the counts of those before it, so
    no task sees all keys."""
    keys = rows.select(F.col(key).alias("key")).where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ranged = keys.repartitionByRange("key").select("key", "n", F.spark_partition_id().alias("part")).sortWithinPartitions("key")
    parts = ranged.groupBy("part").agg(F.sum("n").alias("rows"))
    offset = parts.select("part", F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("key")
    ranked = ranged.withColumn("end", F.sum("n").over(inside)).join(F.broadcast(offset), "part")
    begin = ranked.select("key", (F.col("offset") + F.col("end") - F.col("n")).alias("rank"), "n")
    first = F.ceil(F.col("rank") / size)
    cuts = begin.where((F.col("rank") > 0) & (first * size < F.col("rank") + F.col("n"))).select(F.col("key").alias("low"), first.cast("bigint").alias("step"))
    # cuts are numbered in groups of GROUP steps, and the groups, of which there are few, among themselves
    none = F.lit(None).cast(rows.schema[key].dataType).alias("low")
    cuts = cuts.unionByName(rows.sparkSession.range(1).select(none, F.lit(0).cast("bigint").alias("step"))).withColumn("group", F.expr(f"step div {GROUP}"))
    all_groups = Window.orderBy("group")
    groups = cuts.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min_by("low", "step").alias("head")).select(
        "group", (F.sum("n").over(all_groups) - F.col("n")).alias("before"), F.lead("head").over(all_groups).alias("after")
    )
    own = Window.partitionBy("group").orderBy("step")
    numbered = cuts.select("group", "low", F.row_number().over(own).alias("nth"), F.lead("low").over(own).alias("next")).join(F.broadcast(groups), "group")
    return numbered.select((F.col("before") + F.col("nth") - 1).cast("bigint").alias("chunk_id"), "low", F.coalesce("next", "after").alias("high"))


def is_even(rows: DataFrame, key: str, low: float = FACTOR_LOW, high: float = FACTOR_HIGH) -> bool:
    """Whether an integer key's values are dense enough for fixed steps."""
    if not isinstance(rows.schema[key].dataType, T.ByteType | T.ShortType | T.IntegerType | T.LongType | T.DecimalType):
        return False
    a, b, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
    return bool(n) and low <= distribution_factor(float(a), float(b), n) <= high


def chunks(rows: DataFrame, key: str, size: int = CHUNK_ROWS) -> DataFrame:
    """Even chunks where the key allows, with steps that hold about size rows, else uneven ones."""
    if is_even(rows, key):
        a, b, n = rows.agg(F.min(key), F.max(key), F.count(key)).first()
        return even_chunks(rows, key, max(1, int(distribution_factor(float(a), float(b), n) * size)))
    return uneven_chunks(rows, key, size)


def predicates(bounds: Sequence[tuple], key: str, unbounded_first: bool = False, nulls: bool = False) -> list[str]:
    """SQL predicates of (low, high) bounds for a partitioned JDBC read; with nulls, rows without a key are in the chunk
    that has no low bound. Without bounds there is one chunk of all rows."""
    def shown(v: object) -> str:
        return str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'"

    out = [" AND ".join([f"{key} >= {shown(a)}"] * (a is not None) + [f"{key} < {shown(b)}"] * (b is not None)) or "1 = 1" for a, b in bounds or [(None, None)]]
    if nulls:
        out = [f"{p} OR {key} IS NULL" if a is None and p != "1 = 1" else p for p, (a, _) in zip(out, bounds or [(None, None)], strict=True)]
    return [out[-1], *out[:-1]] if unbounded_first and out else out


def backfilled(snapshot: DataFrame, log: DataFrame, keys: Sequence[str], low: Column | int, high: Column | int) -> DataFrame:
    """A snapshot read between two log positions with the log's changes in between put on top: the state at high.

    snapshot: plain rows. log: a changelog. low and high may be columns of the log (a chunk's own marks)."""
    row = F.struct(*[F.col(f"`{c}`") for c in snapshot.columns])
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in snapshot.schema])
    base = snapshot.select(F.lit("INSERT").alias("op"), F.lit(None).cast(kind).alias("before"), row.cast(kind).alias("after"), F.lit(-(1 << 62)).cast("bigint").alias("seq"))
    between = log.where((F.col("seq") >= low) & (F.col("seq") <= high)).select("op", F.col("before").cast(kind).alias("before"), F.col("after").cast(kind).alias("after"), "seq")
    return materialized(base.unionByName(between), keys)


def replayed(snapshot: DataFrame, log: DataFrame) -> DataFrame:
    """A snapshot without backfill: its rows as inserts, then all of the log. A change may come twice, with its row and
    by itself, so a sink by key is needed."""
    row = F.struct(*[F.col(f"`{c}`") for c in snapshot.columns])
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in snapshot.schema])
    base = snapshot.select(F.lit("INSERT").alias("op"), F.lit(None).cast(kind).alias("before"), row.cast(kind).alias("after"), F.lit(-(1 << 62)).cast("bigint").alias("seq"))
    return base.unionByName(log.select("op", F.col("before").cast(kind).alias("before"), F.col("after").cast(kind).alias("after"), "seq"))


def after_snapshot(log: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """The log's changes that no chunk has: those past the high mark of the chunk that their key is in.

    marks: (low, high, high_mark) for each chunk, low and high bounds of the key, of which no two overlap. Marks and changes
    are dealt to CELLS ranges of keys, whose bounds are those of some chunks, a chunk to each range that it touches; in a
    range a change's chunk is the last one that begins before its key. A change without a key is in no chunk. Few chunks make
    few ranges, and one of them may have all changes, so its changes are shared out, and each share has the range's marks."""
    k = F.coalesce(F.col(f"after.`{key}`"), F.col(f"before.`{key}`"))
    edges = sorted(r[0] for r in marks.where("low is not null").select("low").orderBy(F.xxhash64("low"), "low").limit(CELLS - 1).collect())
    kind = log.select(k.alias("k")).schema["k"].dataType
    cell = lambda x: F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= x)) if edges else F.when(x.isNotNull(), F.lit(0))
    last = F.when(F.col("high").isNull(), F.lit(len(edges))).otherwise(cell(F.col("high")))
    first = F.when(F.col("low").isNull(), F.lit(0)).otherwise(cell(F.col("low")))
    chunk = F.struct(F.col("high").cast(kind).alias("high"), F.col("high_mark").cast("bigint").alias("mark")).alias("chunk")
    row = F.struct(*[F.col(f"`{c}`") for c in log.columns])
    shares = max(SHARED, -(-CELLS // (len(edges) + 1)))
    every = F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share")
    begun = marks.select("*", F.explode(F.sequence(first, last)).alias("cell")).select("cell", every, F.col("low").cast(kind).alias("at"), F.lit(0).alias("side"), chunk)
    begun = begun.withColumn("row", F.lit(None).cast(log.select(row.alias("row")).schema["row"].dataType))
    asked = log.where(k.isNotNull()).select(cell(k).alias("cell"), F.pmod(F.xxhash64(k, "seq"), F.lit(shares)).cast("int").alias("share"), k.alias("at"), F.lit(1).alias("side"), F.lit(None).cast(begun.schema["chunk"].dataType).alias("chunk"), row.alias("row"))
    before = Window.partitionBy("cell", "share").orderBy(F.col("at").asc_nulls_first(), "side").rowsBetween(Window.unboundedPreceding, 0)
    met = begun.unionByName(asked).withColumn("chunk", F.last("chunk", ignorenulls=True).over(before)).where("side = 1 and chunk is not null")
    return met.where((F.col("chunk.high").isNull() | (F.col("at") < F.col("chunk.high"))) & (F.col("row.seq") > F.col("chunk.mark"))).select("row.*")


STARTUP_MODES = ("initial", "earliest-offset", "latest-offset", "specific-offset", "timestamp", "snapshot")


def started(log: DataFrame, mode: str, offset: int | None = None, millis: int | None = None, skip_events: int = 0, latest: int | None = None, skip_rows: int = 0) -> DataFrame:
    """The part of a log that a startup mode reads. initial and earliest-offset read all (initial after the snapshot),
    latest-offset what comes after latest, snapshot nothing. From a specific offset on the first skip_events changes are
    left out, in the order of seq, and then skip_rows more; a change is an event of one row here."""
    if mode not in STARTUP_MODES:
        raise ValueError(f"no startup mode {mode}; one of {', '.join(STARTUP_MODES)}")
    if mode == "snapshot":
        return log.limit(0)
    if mode == "latest-offset":
        return log.where(F.col("seq") > F.lit(latest if latest is not None else (1 << 62)))
    if mode == "specific-offset":
        if offset is None:
            raise ValueError("specific-offset needs an offset")
        rest, skip = log.where(F.col("seq") >= offset), int(skip_events) + int(skip_rows)
        if not skip:
            return rest
        skipped = rest.select("seq").orderBy("seq").limit(skip).agg(F.max("seq").alias("last_"))  # one row
        return rest.join(F.broadcast(skipped), F.col("last_").isNull() | (F.col("seq") > F.col("last_"))).drop("last_")
    if mode == "timestamp":
        if millis is None:
            raise ValueError("timestamp needs a time in milliseconds")
        return log.where(F.col("meta")["op_ts"].cast("bigint") >= millis)
    return log
