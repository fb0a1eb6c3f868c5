"""Mixing sources to target weights by Sainte-Laguë apportionment, with DataFrame operations only.

A source's target is its weight's share of all words, stopped at ``cap`` times what the source has; what is over goes to
the others by weight. Blocks of ``block_words`` words are dealt to the sources by highest quotients target / (2k + 1),
then each source's blocks to its groups of shards and each group's to its shards by highest quotients of their sizes.
Inside a shard the documents stand in a seeded order and form one stream of words, cut into blocks: the shard's quota is
whole passes over it, and for the rest a run of blocks from a seeded one on, around the end, so documents stay whole.

All rounds of dealing rank few quotients however many blocks there are: with n parties, Q seats and quotas q, the
divisor method gives a party between q (1 - n/2Q) - 1 and q (1 + n/2Q) + 1 seats, so only seats in between compete.

Defined results: a null or empty text has 0 words and gets 0; a null source is a source of its own, the last; rows that
repeat are mixed one by one; an empty table gives an empty one; columns besides doc_id, source and text play no part.
Sources are rows of one task, as each one's weight hangs on its place among all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deltaloom.llm.common import WORD, table, written

SEED = 20240601


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], votes: Column, seats: Column) -> DataFrame:
    """parties with a column won: seats by highest quotients votes / (2k + 1), for each group; ties to the first party.

    group may be empty. seats is the number of seats of a row's group; a group without votes gives none."""
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    quota = F.when(F.col("_all") > 0, F.col("_votes") * F.col("_seats") / F.col("_all")).otherwise(F.lit(0.0))
    slack = F.when(F.col("_seats") > 0, F.col("_n") / (2.0 * F.col("_seats"))).otherwise(F.lit(0.0))
    bounded = (
        parties.withColumns({"_votes": votes.cast("double"), "_seats": seats.cast("long")})
        .withColumns({"_all": F.sum("_votes").over(whole), "_n": F.count(F.lit(1)).over(whole)})
        .withColumn("_quota", quota)
        .withColumn("_low", F.greatest(F.lit(0), F.floor(F.col("_quota") * (1 - slack) - 0.5) - 1).cast("long"))
        .withColumn("_high", F.ceil(F.col("_quota") * (1 + slack) + 0.5).cast("long") + 1)
        .withColumn("_left", F.when(F.col("_all") > 0, F.col("_seats") - F.sum("_low").over(whole)).otherwise(F.lit(0)))
    )
    keys = [*group, *party]
    rank = Window.partitionBy(*(group or [F.lit(0)])).orderBy(F.desc("_quotient"), *[F.asc_nulls_last(c) for c in party])
    extra = (
        bounded.select(*keys, "_votes", "_left", F.explode(F.sequence("_low", "_high")).alias("_k"))
        .where(F.col("_votes") > 0)
        .withColumn("_quotient", F.col("_votes") / (2 * F.col("_k") + 1))
        .withColumn("_rank", F.row_number().over(rank))
        .where(F.col("_rank") <= F.col("_left"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_extra"))
    )
    return (
        bounded.join(extra, keys, "left")
        .withColumn("won", F.col("_low") + F.coalesce("_extra", F.lit(0)))
        .drop("_votes", "_seats", "_all", "_n", "_quota", "_low", "_high", "_left", "_extra")
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """sources (key, source, source_size) with weight and target: weights repeat along the sources by code point, null
    last; the level is the first at which the remaining sources can all hold their share."""
    one = Window.partitionBy(F.lit(0))
    named = one.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"))
    by_room = one.orderBy("_room", "key")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    full = F.lit(cap) * F.col("source_size")
    return (
        sources.withColumn("weight", weight)
        .withColumn("_room", full / F.col("weight"))
        .withColumns({"_taken": F.coalesce(F.sum(full).over(before), F.lit(0)), "_weight": F.coalesce(F.sum("weight").over(before), F.lit(0)), "_all": F.sum("source_size").over(one), "_weights": F.sum("weight").over(one)})
        .withColumn("_level", (F.col("_all") - F.col("_taken")) / (F.col("_weights") - F.col("_weight")))
        .withColumn("_level", F.min(F.when(F.col("_room") >= F.col("_level"), F.struct("_room", "key", "_level"))).over(one)["_level"])
        .withColumn("target", F.least(full.cast("double"), F.col("_level") * F.col("weight")))
        .drop("_room", "_taken", "_weight", "_all", "_weights", "_level")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, block_words: int = 16, shard_words: int = 250_000, shard_rows: int = 5000, group_shards: int = 4096, seed: int = SEED, carry: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of docs (doc_id, source, text), and tag, the numbers of the
    column that carry names, if it names one.

    A source has a shard for each shard_words words or shard_rows rows, and a group for each group_shards shards, so
    neither the documents of a shard nor the shards of a group pile up; documents are dealt to shards by a seeded hash of
    their ids and texts."""
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = written(
        docs.select(
            F.col("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            order.alias("_order"),
            (F.col(f"`{carry}`") if carry else F.lit(0)).cast("long").alias("tag"),
        )
    )
    sources = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    sources = targets(sources, weights, cap)
    total = Window.partitionBy(F.lit(0))
    sources = sources.withColumn("_blocks", F.round(F.sum("source_size").over(total) / block_words).cast("long"))
    sources = written(
        sainte_lague(sources, [], ["key"], F.col("target"), F.col("_blocks")).select(
            "key", "source_size", "target", F.col("won").alias("_blocks"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("_rows") / shard_rows)).cast("long").alias("_shards"),
        )
    )
    placed = sized.join(sources, "key").withColumn("_shard", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_order")), F.col("_shards")))
    shards = placed.groupBy("key", "_shard").agg(F.sum("size").alias("_size"), F.first("_blocks").alias("_blocks")).withColumn("_group", F.expr(f"_shard div {group_shards}"))
    groups = shards.groupBy("key", "_group").agg(F.sum("_size").alias("_votes_"), F.first("_blocks").alias("_blocks"))
    groups = sainte_lague(groups, ["key"], ["_group"], F.col("_votes_"), F.col("_blocks")).select("key", "_group", F.col("won").alias("_seats_"))
    start = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("key"), F.col("_shard")), F.greatest(F.lit(1), F.ceil(F.col("_size") / block_words)))
    quotas = sainte_lague(shards.drop("_blocks").join(groups, ["key", "_group"]), ["key", "_group"], ["_shard"], F.col("_size"), F.col("_seats_")).select(
        "key", "_shard", "_size", F.least(F.col("won") * block_words, F.col("_size") * cap).alias("_words"), (start * block_words).alias("_from")
    )
    stream = Window.partitionBy("key", "_shard").orderBy("_order", "doc_id", "size", "tag").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(stream), F.lit(0))
    passes = F.when(F.col("_size") > 0, F.floor(F.col("_words") / F.col("_size"))).otherwise(F.lit(0)).cast("long")
    inside = lambda a, b: F.greatest(F.lit(0), F.least(F.col("_before") + F.col("size"), b) - F.greatest(F.col("_before"), a))
    return (
        placed.join(quotas, ["key", "_shard"])
        .withColumns({"_before": before, "_passes": passes})
        .withColumn("_to", F.col("_from") + F.col("_words") - F.col("_passes") * F.col("_size"))
        .select(
            "doc_id", *["tag"] * bool(carry), "source", "size", "source_size", "target",
            (F.col("_passes") * F.col("size") + inside(F.col("_from"), F.col("_to")) + inside(F.lit(0), F.col("_to") - F.col("_size"))).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **options: object) -> DataFrame:
    """docs with each row as often as the mix takes it, to the nearest whole copy; all columns stay.

    Rows are told apart by an own number written with them, so repeated ids are no matter."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = written(docs.select(row, F.monotonically_increasing_id().alias("tag")))
    copies = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    plan = mix(kept.select("tag", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "source", "text")]), carry="tag", **options).select("tag", copies.alias("copies")).where("copies > 0")
    return kept.join(plan, "tag").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
