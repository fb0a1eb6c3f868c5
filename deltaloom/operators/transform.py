"""Transform rules: the first that matches a table projects and filters its changelog."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.catalog import Schema, TableId, Type
from deltaloom.exprs import Compiler, compile_filter, compile_projection
from deltaloom.exprs.grammar import parse_expression, parse_projection, referenced
from deltaloom.operators import changelog
from deltaloom.sources.selectors import Selectors

#: Metadata columns that any table has.
METADATA = ("__namespace_name__", "__schema_name__", "__table_name__", "__data_event_type__")
CONVERTERS = ("SOFT_DELETE",)


@dataclass(frozen=True)
class TransformRule:
    source_table: str
    projection: str | None = None
    filter: str | None = None
    primary_keys: tuple[str, ...] = ()
    partition_keys: tuple[str, ...] = ()
    table_options: Mapping[str, str] = field(default_factory=dict)
    converter: str | None = None
    description: str | None = None

    def matches(self, table: TableId) -> bool:
        return Selectors(self.source_table).matches(table)


def options_of(text: str, delimiter: str = ",") -> dict[str, str]:
    """k=v pairs of a table-options text."""
    pairs = [p.strip() for p in text.split(delimiter) if p.strip()]
    if bad := [p for p in pairs if "=" not in p]:
        raise ValueError(f"not key=value: {bad[0]!r}")
    return {k.strip(): v.strip() for k, v in (p.split("=", 1) for p in pairs)}


def names_of(text: str | None) -> tuple[str, ...]:
    return tuple(x.strip() for x in (text or "").split(",") if x.strip())


def rule_for(table: TableId, rules: Iterable[TransformRule]) -> TransformRule | None:
    """Only the first rule that matches applies."""
    return next((r for r in rules if r.matches(table)), None)


def has_wildcard(rule: TransformRule) -> bool:
    return any(tree is None for tree, _ in parse_projection(rule.projection))


def referenced_columns(rule: TransformRule, schema: Schema) -> list[str]:
    """The physical columns that projection and filter read, in the table's order; all of them with a wildcard."""
    if has_wildcard(rule):
        return schema.names
    seen: set[str] = set()
    for tree, _ in parse_projection(rule.projection):
        seen |= referenced(tree)
    if rule.filter and rule.filter.strip():
        computed = {a: t for t, a in parse_projection(rule.projection) if t is not None}
        for name in referenced(parse_expression(rule.filter)):
            seen |= referenced(computed[name]) if name in computed and name not in schema.names else {name}
    return [n for n in schema.names if n in seen]


class Transform:
    """A rule for one table: columns and filter of one side, compiled once at planning."""

    def __init__(self, rule: TransformRule, table: TableId, schema: Schema, changes: DataFrame, udfs: Mapping[str, Callable] | None = None, metadata: Mapping[str, str] | None = None) -> None:
        """metadata: the source's own metadata columns and their types, read out of meta."""
        if rule.converter and rule.converter.upper() not in CONVERTERS:
            raise ValueError(f"no converter {rule.converter}")
        self.rule, self.table, self.schema, self.changes = rule, table, schema, changes
        self.udfs, self.metadata = udfs, dict(metadata or {})

    def side(self, side: str) -> tuple[dict[str, Column], Column | None]:
        spark = self.changes.sparkSession
        own = {n: F.col(f"{side}.`{n}`") for n in self.schema.names}
        before, after = changelog.row_kinds(F.col("_kind"))
        hidden = {
            "__namespace_name__": F.lit(self.table.namespace or ""), "__schema_name__": F.lit(self.table.schema or ""), "__table_name__": F.lit(self.table.table),
            "__data_event_type__": before if side == "before" else after,
        } | {n: F.col("meta")[n].cast(Type.parse(t).spark()) for n, t in self.metadata.items()}
        sided = self.changes.schema[side].dataType
        compiler = Compiler(spark, sided, own | hidden, self.udfs)
        compiler.empty = self.changes.withColumn("_kind", F.col("op"))
        projected = compile_projection(compiler, self.rule.projection, set(hidden))
        # the filter sees computed columns too, physical ones first where the names are the same
        filters = Compiler(spark, sided, projected | own | hidden, self.udfs)
        filters.empty = compiler.empty
        return projected, compile_filter(filters, self.rule.filter)

    def run(self) -> DataFrame:
        """The projected changelog."""
        sides = {s: self.side(s) for s in ("before", "after")}
        changes = self.changes.withColumn("_kind", F.col("op"))
        if sides["after"][1] is not None:
            changes = changelog.filtered(changes, sides["before"][1], sides["after"][1])
        if (self.rule.converter or "").upper() == "SOFT_DELETE":
            # a deletion becomes an insert of its before; its event type stays
            gone, (b, _), (a, _) = F.col("op") == "DELETE", sides["before"], sides["after"]
            struct = {s: F.struct(*[c.alias(n) for n, c in p.items()]) for s, p in (("before", b), ("after", a))}
            keep = [c for c in changes.columns if c not in ("op", "before", "after", "_kind")]
            return changes.select(
                F.when(gone, "INSERT").otherwise(F.col("op")).alias("op"), F.when(~gone & F.col("before").isNotNull(), struct["before"]).alias("before"),
                F.when(gone, struct["before"]).when(F.col("after").isNotNull(), struct["after"]).alias("after"), *keep,
            )
        projected = {s: F.when(F.col(s).isNotNull(), F.struct(*[c.alias(n) for n, c in p.items()])).alias(s) for s, (p, _) in sides.items()}
        keep = [c for c in changes.columns if c not in ("op", "before", "after", "_kind")]
        return changes.select("op", projected["before"], projected["after"], *keep)

    def output_schema(self) -> Schema:
        """The schema that the sink gets, with the rule's keys and options; it is known though no row passes."""
        kinds = self.run().schema["after"].dataType
        known = {c.name: c for c in self.schema.columns}
        forwarded = {a for t, a in parse_projection(self.rule.projection) if t is not None and t[0] == "column" and t[1] == a}
        wild = has_wildcard(self.rule)
        computed = {a for t, a in parse_projection(self.rule.projection) if t is not None} - forwarded
        out = Schema.from_spark(kinds)
        columns = tuple(known[c.name] if c.name in known and c.name not in computed and (wild or c.name in forwarded) else c for c in out.columns)
        keys = self.rule.primary_keys or tuple(k for k in self.schema.primary_keys if k in out.names)
        return replace(out, columns=columns, options={**self.schema.options, **self.rule.table_options}, partition_keys=self.rule.partition_keys or self.schema.partition_keys, comment=self.schema.comment).keyed(keys)


def transform_rows(rows: DataFrame, projection: str | None = None, filter: str | None = None, udfs: Mapping[str, Callable] | None = None) -> DataFrame:
    """A projection and filter over plain rows, as over a table of inserts only: one select, for Catalyst to fuse."""
    compiler = Compiler(rows.sparkSession, rows.schema, udfs=udfs)
    compiler.empty = rows
    projected = compile_projection(compiler, projection)
    # a filter reads the rows' own columns first, and computed ones by their definition: it can reach the scan
    filters = Compiler(rows.sparkSession, rows.schema, projected | compiler.columns, udfs)
    filters.empty = rows
    passes = compile_filter(filters, filter)
    kept = rows if passes is None else rows.where(passes)
    return kept.select(*[c.alias(n) for n, c in projected.items()])
