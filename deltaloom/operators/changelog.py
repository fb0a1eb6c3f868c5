"""The envelope of a table's changes and what can be done with a changelog.

A changelog is a DataFrame with op (INSERT, UPDATE, REPLACE or DELETE), before and after (structs of the table's
columns), meta (map<string,string>) and seq (a number that orders a table's changes). An insert or replacement has no
before, a deletion no after."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPS = ("INSERT", "UPDATE", "REPLACE", "DELETE")
META = T.MapType(T.StringType(), T.StringType())


def envelope(rows: DataFrame, op: Column | str = "INSERT", seq: Column | None = None, meta: Column | None = None) -> DataFrame:
    """Rows as changes: after is the row, or before for a deletion."""
    op = F.lit(op) if isinstance(op, str) else op
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.select(
        op.alias("op"), F.when(op == "DELETE", row).alias("before"), F.when(op != "DELETE", row).alias("after"),
        (F.lit(None).cast(META) if meta is None else meta.cast(META)).alias("meta"), (F.lit(0).cast("bigint") if seq is None else seq.cast("bigint")).alias("seq"),
    )


def validated(changes: DataFrame) -> DataFrame:
    """changes, failing at run time on a row whose sides don't suit its op."""
    good = (
        F.when(F.col("op").isin("INSERT", "REPLACE"), F.col("before").isNull() & F.col("after").isNotNull())
        .when(F.col("op") == "UPDATE", F.col("before").isNotNull() & F.col("after").isNotNull())
        .when(F.col("op") == "DELETE", F.col("before").isNotNull() & F.col("after").isNull())
        .otherwise(F.lit(False))
    )
    return changes.withColumn("op", F.when(good, F.col("op")).otherwise(F.raise_error(F.concat(F.lit("a change of kind "), F.coalesce("op", F.lit("NULL")), F.lit(" with the wrong sides")))))


def row_kinds(op: Column) -> tuple[Column, Column]:
    """The row kinds of before and after; a replacement has none."""
    no = F.raise_error(F.lit("REPLACE has no row kind")).cast("string")
    before = F.when(op == "UPDATE", "-U").when(op == "DELETE", "-D").when(op == "REPLACE", no)
    return before, F.when(op == "INSERT", "+I").when(op == "UPDATE", "+U").when(op == "REPLACE", no)


def exploded(changes: DataFrame) -> DataFrame:
    """A row for each side (row_kind, the table's columns, meta, seq): what a retracting consumer reads."""
    before, after = row_kinds(F.col("op"))
    sides = F.array(F.struct(before.alias("kind"), F.col("before").alias("row")), F.struct(after.alias("kind"), F.col("after").alias("row")))
    return changes.select(F.explode(F.filter(sides, lambda s: s["row"].isNotNull())).alias("side"), "meta", "seq").select(F.col("side.kind").alias("row_kind"), "side.row.*", "meta", "seq")


def append_only(changes: DataFrame) -> DataFrame:
    """Each side of each change as an INSERT of its own."""
    sides = F.filter(F.array("before", "after"), lambda r: r.isNotNull())
    return changes.select(F.lit("INSERT").alias("op"), F.lit(None).cast(changes.schema["before"].dataType).alias("before"), F.explode(sides).alias("after"), "meta", "seq")


def upserts(changes: DataFrame) -> DataFrame:
    """Without the rows that an update retracts: before stays only in deletions."""
    return changes.withColumn("before", F.when(F.col("op") == "DELETE", F.col("before")))


def soft_deletes(changes: DataFrame) -> DataFrame:
    """Deletions as inserts of what was deleted; kind keeps what each change was."""
    gone = F.col("op") == "DELETE"
    return changes.select(
        F.when(gone, "INSERT").otherwise(F.col("op")).alias("op"), F.when(~gone, F.col("before")).alias("before"), F.when(gone, F.col("before")).otherwise(F.col("after")).alias("after"),
        *[c for c in changes.columns if c not in ("op", "before", "after")],
    )


def filtered(changes: DataFrame, before_passes: Column, after_passes: Column) -> DataFrame:
    """Each side judged alone: an update that leaves the filter deletes, one that enters inserts."""
    b, a = F.coalesce(before_passes, F.lit(False)) & F.col("before").isNotNull(), F.coalesce(after_passes, F.lit(False)) & F.col("after").isNotNull()
    rest = [c for c in changes.columns if c not in ("op", "before", "after")]
    return (
        changes.withColumns({"_b": b, "_a": a})
        .where("_a or _b")
        .select(
            F.when(F.col("op") != "UPDATE", F.col("op")).when(F.col("_b") & F.col("_a"), "UPDATE").when(F.col("_b"), "DELETE").otherwise("INSERT").alias("op"),
            F.when(F.col("_b"), F.col("before")).alias("before"), F.when(F.col("_a"), F.col("after")).alias("after"), *rest,
        )
    )


def derived(rows: DataFrame, keys: Sequence[str], order: Sequence[str], last_is_delete: Column | None = None) -> DataFrame:
    """A changelog of rows that are successive states of their keys: the first inserts, later ones update; where
    last_is_delete holds, the key's last row deletes what stood before it. The first of a key always inserts."""
    window = Window.partitionBy(*keys).orderBy(*order)
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    placed = rows.select(row.alias("row"), F.lag(row).over(window).alias("old"), (F.lead(F.lit(1)).over(window).isNull() if last_is_delete is not None else F.lit(False)).alias("last"), *([last_is_delete.alias("gone")] if last_is_delete is not None else [F.lit(False).alias("gone")]), F.row_number().over(window).alias("seq"))
    gone = F.col("last") & F.col("gone") & F.col("old").isNotNull()
    op = F.when(F.col("old").isNull(), "INSERT").when(gone, "DELETE").otherwise("UPDATE")
    return placed.select(op.alias("op"), F.col("old").alias("before"), F.when(~gone, F.col("row")).alias("after"), F.lit(None).cast(META).alias("meta"), F.col("seq").cast("bigint").alias("seq"))


def materialized(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that a changelog leaves: the last after of each key that wasn't deleted."""
    return last_effects(changes, keys).where("row is not null").select("row.*")


def effects(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, row, at): what each change does to a key, row null where it removes it; at orders them. An update that
    changes the key removes the old one."""
    row = lambda side: F.struct(*[F.col(f"{side}.`{k}`").alias(k) for k in keys])
    moved = (F.col("op") == "UPDATE") & ~row("before").eqNullSafe(row("after"))
    done = F.array_compact(
        F.array(
            F.when(moved | (F.col("op") == "DELETE"), F.struct(row("before").alias("key"), F.lit(0).alias("place"), F.lit(None).cast(changes.schema["after"].dataType).alias("row"))),
            F.when(F.col("op") != "DELETE", F.struct(row("after").alias("key"), F.lit(1).alias("place"), F.col("after").alias("row"))),
        )
    )
    return changes.select(F.explode(done).alias("e"), "seq").select("e.key", "e.row", F.struct("seq", F.col("e.place").alias("place")).alias("at"))


def last_effects(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, row) for each key that changes touch: the row it is left with, null if with none.

    The last change of a key is an aggregate, max_by over (seq, place), so keys with long histories combine map-side;
    a change that can't alter the outcome never leaves its task."""
    return effects(changes, keys).groupBy("key").agg(F.max_by(F.struct("row"), "at").alias("last")).select("key", "last.row")


def partitioned(changes: DataFrame, strategy: str, keys: Sequence[str] = (), count: int | None = None) -> DataFrame:
    """Changes dealt so that a key's stay in order in one partition (PRIMARY_KEY), or so that a table's stay in order (TABLE_ID).

    A table may be larger than a task should hold, so TABLE_ID deals tables as ranges of seq: a table's partitions follow one
    another by number, each in the order of seq. Changes of one seq, which have no order, may lie in several."""
    if strategy not in ("PRIMARY_KEY", "TABLE_ID", "SINK_DEFINED"):
        raise ValueError(f"no partition strategy {strategy}")
    by = [F.col("table_id")] if "table_id" in changes.columns else []
    if strategy == "TABLE_ID" and by:
        sides = F.struct("before", "after")
        if any(kind in changes.select(sides).schema.simpleString() for kind in ("map<", "variant")):  # which Spark doesn't hash
            sides = F.to_json(sides)
        by += [F.col("seq"), F.xxhash64(sides)]
        return (changes.repartitionByRange(count, *by) if count else changes.repartitionByRange(*by)).sortWithinPartitions("table_id", "seq")
    if strategy != "TABLE_ID":
        by += [F.coalesce(F.col(f"before.`{k}`"), F.col(f"after.`{k}`")) for k in keys]
    if not by:
        raise ValueError("there is no key to partition by")
    return (changes.repartition(count, *by) if count else changes.repartition(*by)).sortWithinPartitions("seq")
