"""Positions in a log that aren't one number: sets of transactions by server, and vectors over shards.

A set of transactions (a GTID set, ``server:1-19:25,other:1-4``) tells which ones a reader has. After a failover another
server's log has the same transactions in other places, and what is still to come is what the set lacks. A vector over
shards (a VGTID) is a position for each; two readers' vectors meet component by component, and a shard that is split or
merged is followed by others from a position on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers whose gaps one task looks for.
RANGE = 1 << 16


@dataclass(frozen=True)
class Transactions:
    """Intervals (low, high), both in the set, in order and apart from one another, for each server."""

    servers: Mapping[str, tuple[tuple[int, int], ...]]

    @classmethod
    def of(cls, intervals: Mapping[str, Sequence[tuple[int, int]]]) -> Transactions:
        out = {}
        for server, own in intervals.items():
            joined: list[tuple[int, int]] = []
            for low, high in sorted((int(a), int(b)) for a, b in own if a <= b):
                if joined and low <= joined[-1][1] + 1:
                    joined[-1] = (joined[-1][0], max(high, joined[-1][1]))
                else:
                    joined.append((low, high))
            if joined:
                out[server] = tuple(joined)
        return cls(out)

    @classmethod
    def parse(cls, text: str) -> Transactions:
        intervals: dict[str, list[tuple[int, int]]] = {}
        for one in filter(None, (x.strip() for x in text.split(","))):
            server, *ranges = one.split(":")
            if not ranges:
                raise ValueError(f"not a set of transactions: {one!r}")
            for r in ranges:
                low, _, high = r.partition("-")
                if not low.isdigit() or high and not high.isdigit():
                    raise ValueError(f"not an interval: {r!r}")
                intervals.setdefault(server.lower(), []).append((int(low), int(high or low)))
        return cls.of(intervals)

    def __str__(self) -> str:
        shown = lambda a, b: str(a) if a == b else f"{a}-{b}"
        return ",".join(f"{s}:{':'.join(shown(*i) for i in own)}" for s, own in sorted(self.servers.items()))

    def union(self, other: Transactions) -> Transactions:
        return Transactions.of({s: (*self.servers.get(s, ()), *other.servers.get(s, ())) for s in {*self.servers, *other.servers}})

    def minus(self, other: Transactions) -> Transactions:
        out: dict[str, list[tuple[int, int]]] = {}
        for server, own in self.servers.items():
            for low, high in own:
                at = low
                for a, b in other.servers.get(server, ()):
                    if b < at or a > high:
                        continue
                    out.setdefault(server, []).append((at, a - 1))
                    at = max(at, b + 1)
                out.setdefault(server, []).append((at, high))
        return Transactions.of(out)

    def contains(self, other: Transactions) -> bool:
        return not other.minus(self).servers

    def has(self, server: Column, number: Column) -> Column:
        """Whether a transaction is in the set; one without a server or number is in none."""
        out = F.lit(False)
        for name, own in sorted(self.servers.items()):
            inside = F.exists(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in own]), lambda i: (number >= i["a"]) & (number <= i["b"]))
            out = out | ((F.lower(server) == name) & inside)
        return F.coalesce(out, F.lit(False))


def executed(log: DataFrame, server: str, number: str) -> DataFrame:
    """(server, low, high): the intervals of the transactions that a log holds.

    Numbers are looked at in ranges of RANGE, so no task has all of a server; what is left, an interval or more for each range,
    is joined by a second pass over these."""
    one = log.select(F.lower(F.col(server)).alias("server"), F.col(number).cast("bigint").alias("n")).where("server is not null and n is not null")
    one = one.withColumn("range", F.floor(F.col("n") / RANGE)).distinct()
    inside = Window.partitionBy("server", "range").orderBy("n")
    runs = one.withColumn("run", F.col("n") - F.row_number().over(inside)).groupBy("server", "range", "run").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    order = Window.partitionBy("server").orderBy("low")
    fresh = F.coalesce((F.col("low") > F.lag("high").over(order) + 1).cast("int"), F.lit(1))
    return runs.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(order)).groupBy("server", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("run")


def transactions_of(log: DataFrame, server: str, number: str) -> Transactions:
    """The set of what a log holds, on the driver: as many intervals as the log has gaps."""
    own: dict[str, list[tuple[int, int]]] = {}
    for r in executed(log, server, number).collect():
        own.setdefault(r["server"], []).append((r["low"], r["high"]))
    return Transactions.of(own)


def to_come(log: DataFrame, known: Transactions, server: str, number: str) -> DataFrame:
    """What a reader of the known transactions hasn't had of a log, whichever server's it is."""
    return log.where(~known.has(F.col(server), F.col(number)))


@dataclass(frozen=True)
class Reshard:
    """Shards that end at a position each, and the shards that follow them."""

    ended: Mapping[str, int]
    begun: tuple[str, ...]


@dataclass(frozen=True)
class Shards:
    """A position for each shard that is followed."""

    positions: Mapping[str, int]

    def merged(self, other: Shards) -> Shards:
        """The later position of each shard."""
        return Shards({s: max(p for p in (self.positions.get(s), other.positions.get(s)) if p is not None) for s in {*self.positions, *other.positions}})

    def reached(self, other: Shards) -> bool:
        """Whether each of other's shards has been read that far."""
        return all(self.positions.get(s, -1) >= p for s, p in other.positions.items())

    def resharded(self, change: Reshard) -> Shards:
        """After a change: only once all that ends has been read to its end."""
        if not self.reached(Shards(change.ended)):
            raise ValueError(f"{sorted(change.ended)} haven't been read to their ends")
        return Shards({s: p for s, p in self.positions.items() if s not in change.ended} | dict.fromkeys(change.begun, 0))


def generations(changes: Sequence[Reshard]) -> dict[str, int]:
    """How many changes lie before each shard: what a shard says comes after all that those before it said."""
    out: dict[str, int] = {}
    for change in changes:
        last = max((out.get(s, 0) for s in change.ended), default=0)
        out.update({s: last + 1 for s in change.begun})
    return out


def by_vector(log: DataFrame, shard: str, position: str, changes: Sequence[Reshard] = (), since: Shards | None = None) -> DataFrame:
    """Changes of several shards with seq, which orders those of a key in whatever order the shards arrive: by the shard's
    generation, then its position. What a shard says after its end, and what since has, is left out."""
    number = F.lit(0)
    for name, generation in generations(changes).items():
        number = F.when(F.col(shard) == name, generation).otherwise(number)
    out = log.withColumn("seq", number * F.lit(1 << 48) + F.col(position))
    for name, end in [(n, p) for c in changes for n, p in c.ended.items()]:
        out = out.where((F.col(shard) != name) | (F.col(position) <= end))
    for name, have in (since.positions if since else {}).items():
        out = out.where((F.col(shard) != name) | (F.col(position) > have))
    return out
