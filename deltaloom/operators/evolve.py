"""Schema evolution: what a sink does about changes of a table's schema, and rows brought to the evolved one."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.catalog import Change, Schema, TableId, Type, accepted_kinds, apply_change, difference, is_redundant, least_common_schema, lenient

BEHAVIORS = ("IGNORE", "LENIENT", "TRY_EVOLVE", "EVOLVE", "EXCEPTION")


def coerced_value(c: Column, source: Type, target: Type, tolerant: bool = True) -> Column:
    """A value in another type; in tolerant mode what can't be is NULL, else the query fails."""
    if source.root == target.root and source.args == target.args:
        return c
    kind = target.spark()
    if isinstance(kind, T.StringType):
        if source.root in ("BINARY", "VARBINARY", "BYTES"):
            return F.base64(c)
        if source.root in ("ARRAY", "MAP", "ROW", "VARIANT"):
            return F.to_json(c)
        return c if isinstance(source.spark(), T.StringType) else c.cast("string")
    if target.root == "TIMESTAMP_TZ":
        zoned = c if source.root == "TIMESTAMP_TZ" else F.struct(c.cast("timestamp").alias("ts"), F.current_timezone().alias("zone"))
        return F.when(c.isNotNull(), zoned)
    if source.root == "TIMESTAMP_TZ":
        c = c["ts"]
    return c.try_cast(kind) if tolerant else c.cast(kind)


def coerced(row: Column, source: Schema, target: Schema, tolerant: bool = True) -> Column:
    """A struct of source's columns as one of target's: aligned by name, what is missing is NULL."""
    fields = []
    for c in target.columns:
        own = source.get(c.name)
        fields.append((F.lit(None).cast(c.type.spark()) if own is None else coerced_value(row.getField(c.name), own.type, c.type, tolerant)).alias(c.name))
    return F.struct(*fields)


@dataclass
class Registry:
    """The schemas that sources have now and sinks have been given. It can be written to and read from JSON, to stand
    beside a stream's checkpoint."""

    sources: dict[str, Schema] = field(default_factory=dict)
    sinks: dict[str, Schema] = field(default_factory=dict)
    version: int = -1

    def dump(self) -> str:
        def plain(s: Schema) -> dict:
            return {"columns": [[c.name, str(c.type), c.comment, c.default] for c in s.columns], "keys": s.primary_keys, "partitions": s.partition_keys, "options": s.options, "comment": s.comment}

        return json.dumps({"version": self.version, "sources": {k: plain(v) for k, v in self.sources.items()}, "sinks": {k: plain(v) for k, v in self.sinks.items()}})

    @classmethod
    def load(cls, text: str) -> Registry:
        from deltaloom.catalog import Column as TableColumn

        def schema(d: dict) -> Schema:
            return Schema(tuple(TableColumn(n, Type.parse(t), c, e) for n, t, c, e in d["columns"]), tuple(d["keys"]), tuple(d["partitions"]), d["options"], d["comment"])

        d = json.loads(text)
        return cls({k: schema(v) for k, v in d["sources"].items()}, {k: schema(v) for k, v in d["sinks"].items()}, d["version"])


class SchemaEvolution:
    """Turns changes of source tables into the changes that their sink applies, by the chosen behaviour.

    EXCEPTION fails on any change but a creation, IGNORE drops them, EVOLVE applies them and fails where the sink can't,
    TRY_EVOLVE keeps the sink's schema where it can't, LENIENT keeps all that the sink has (see catalog.lenient)."""

    def __init__(self, behavior: str = "LENIENT", include: list[str] | None = None, exclude: list[str] | None = None, registry: Registry | None = None) -> None:
        if behavior not in BEHAVIORS:
            raise ValueError(f"no schema change behaviour {behavior}; one of {', '.join(BEHAVIORS)}")
        self.behavior, self.accepted, self.registry = behavior, accepted_kinds(include, exclude, behavior), registry or Registry()

    def arrive(self, change: Change, sink: TableId, apply=None) -> list[Change]:
        """A change of a source table. apply(change) is the sink's own DDL. Returns what was applied."""
        source, target = str(change.table), str(sink)
        if is_redundant(self.registry.sources.get(source), change):
            return []
        if change.kind != "create.table":
            if self.behavior == "EXCEPTION":
                raise ValueError(f"{change.kind} of {change.table}: schema changes aren't allowed")
        before = self.registry.sources.get(source)
        self.registry.sources[source] = apply_change(before, change)
        if self.behavior == "IGNORE" and change.kind != "create.table":
            return []
        own = self.registry.sinks.get(target)
        if change.kind == "create.table":
            steps = difference(sink, own, change.schema if own is None else least_common_schema(own, change.schema))
        elif change.kind in ("drop.table", "truncate.table", "table.comment"):
            steps = lenient(own, change) if self.behavior == "LENIENT" else [change]
        elif self.behavior == "LENIENT":
            steps = lenient(before if own is None else own, change)
        else:
            steps = [change]
        done = []
        for step in steps:
            step = Change(sink, step.kind, step.schema, step.added, step.types, step.dropped, step.renamed, step.comment)
            if step.kind not in self.accepted or is_redundant(self.registry.sinks.get(target), step):
                continue
            try:
                now = apply_change(self.registry.sinks.get(target), step)
                if apply is not None:
                    apply(step)
            except Exception:
                if self.behavior == "TRY_EVOLVE":
                    continue
                raise
            self.registry.sinks[target] = now
            done.append(step)
        return done
