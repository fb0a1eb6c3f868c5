"""Routes: which sink tables a source table goes to, and the merge of tables that share one."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deltaloom.catalog import Schema, TableId, least_common_schema
from deltaloom.operators.evolve import coerced


@dataclass(frozen=True)
class RouteRule:
    source_table: str
    sink_table: str
    replace_symbol: str | None = None
    description: str | None = None


def pattern(text: str) -> str:
    """The regular expression of a route's source: commas part alternatives, a plain dot is itself, an escaped dot is
    any character."""
    out = "|".join(x.strip() for x in re.split(r"(?<!\\),", text))
    held = "\0"
    return out.replace("\\.", held).replace(".", "\\.").replace(held, ".")


def targets(table: TableId, rules: Iterable[RouteRule], mode: str = "ALL_MATCH") -> list[TableId]:
    """Where a table goes: to the sink of each rule that matches in full, or of the first (FIRST_MATCH); itself if none."""
    if mode not in ("ALL_MATCH", "FIRST_MATCH"):
        raise ValueError(f"no route mode {mode}")
    out = []
    for rule in rules:
        found = re.fullmatch(pattern(rule.source_table), str(table))
        if not found:
            continue
        if rule.replace_symbol:
            sink = rule.sink_table.replace(rule.replace_symbol, table.table)
        else:
            sink = re.sub(r"\$(\d)", lambda m, g=found: g.group(int(m[1])) or "", rule.sink_table)
        out.append(TableId.parse(sink))
        if mode == "FIRST_MATCH":
            break
    return out or [table]


def routed(tables: Iterable[TableId], rules: Iterable[RouteRule], mode: str = "ALL_MATCH") -> dict[TableId, list[TableId]]:
    """The source tables of each sink table, in order."""
    rules, out = list(rules), {}
    for table in tables:
        for sink in targets(table, rules, mode):
            out.setdefault(sink, []).append(table)
    return out


def merged_schema(schemas: Iterable[Schema]) -> Schema:
    """The least common schema of tables that share a sink."""
    out = None
    for schema in schemas:
        out = least_common_schema(out, schema)
    if out is None:
        raise ValueError("no schemas to merge")
    return out


def merged(changes: Mapping[TableId, DataFrame], schemas: Mapping[TableId, Schema], sink: TableId) -> tuple[DataFrame, Schema]:
    """The changelogs of tables as one of the sink's, columns aligned by name and widened; what a table lacks is NULL.

    A union of selects: no shuffle."""
    schema, out = merged_schema(schemas[t] for t in changes), None
    for table, frame in changes.items():
        sides = {s: F.when(F.col(s).isNotNull(), coerced(F.col(s), schemas[table], schema)).alias(s) for s in ("before", "after")}
        rest = [c for c in frame.columns if c not in ("before", "after", "table_id")]
        one = frame.select(F.lit(str(sink)).alias("table_id"), *rest, sides["before"], sides["after"])
        out = one if out is None else out.unionByName(one)
    return out, schema


def merged_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Plain rows of shards as one table of their least common schema."""
    schemas = {n: Schema.from_spark(f.schema) for n, f in tables.items()}
    schema, out = merged_schema(schemas.values()), None
    for name, frame in tables.items():
        row = F.struct(*[F.col(f"`{c}`") for c in frame.columns])
        one = frame.select(coerced(row, schemas[name], schema).alias("row")).select("row.*")
        out = one if out is None else out.unionByName(one)
    return out
