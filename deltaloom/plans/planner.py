"""From a definition to lazy DataFrames: source, transform, route and merge, evolve, partition, sink."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from deltaloom.catalog import Change, Schema, TableId
from deltaloom.functions.udfs import registered
from deltaloom.operators import changelog, route
from deltaloom.operators.evolve import SchemaEvolution
from deltaloom.operators.transform import Transform, TransformRule, rule_for
from deltaloom.plans.definition import PipelineDef, parse
from deltaloom.sinks.registry import Sink, open_sink
from deltaloom.sources.metrics import observed
from deltaloom.sources.registry import Source, open_source


@dataclass
class Planned:
    """For each sink table its changelog (lazy) and schema."""

    tables: dict[TableId, tuple[DataFrame, Schema]]


def transformed(source: Source, rules: tuple[TransformRule, ...], udfs: Mapping[str, Callable] | None = None) -> tuple[dict[TableId, DataFrame], dict[TableId, Schema]]:
    frames, schemas = {}, {}
    for table, changes in source.tables.items():
        rule = rule_for(table, rules)
        if rule is None:
            frames[table], schemas[table] = changes, source.schemas[table]
            continue
        one = Transform(rule, table, source.schemas[table], changes, udfs, source.metadata)
        frames[table], schemas[table] = one.run(), one.output_schema()
    return frames, schemas


def planned(spark: SparkSession, definition: PipelineDef, sources: list[Source] | None = None, sink: Sink | None = None) -> Planned:
    """The plan of a bounded run: nothing is read yet but for schemas."""
    opened = sources or [open_source(spark, {"type": s.type, **s.options}) for s in definition.sources]
    udfs = registered(definition.udfs, definition.models)
    frames: dict[TableId, DataFrame] = {}
    schemas: dict[TableId, Schema] = {}
    for one in opened:
        f, s = transformed(one, definition.transforms, udfs)
        if again := set(f) & set(frames):
            raise ValueError(f"two sources have {sorted(again)[0]}")
        frames |= f
        schemas |= s
    strategy = definition.config["partition.strategy"]
    if sink is not None and sink.own_hash and strategy not in (None, "SINK_DEFINED"):
        raise ValueError(f"the sink partitions by its own hash; {strategy} can't be chosen")
    out = {}
    for target, tables in route.routed(frames, definition.routes, definition.config["route-mode"]).items():
        merged, schema = route.merged({t: frames[t] for t in tables}, schemas, target)
        if strategy in ("PRIMARY_KEY", "TABLE_ID") and (schema.primary_keys or strategy == "TABLE_ID"):
            merged = changelog.partitioned(merged, strategy, schema.primary_keys)
        out[target] = (merged, schema)
    return Planned(out)


def run(spark: SparkSession, definition: PipelineDef | str, sink: Sink | None = None, batch: int = 0) -> Sink:
    """Runs a bounded pipeline: tables are created in the sink, then their changes written."""
    definition = parse(definition) if isinstance(definition, str) else definition
    zone = definition.config["local-time-zone"]
    if zone != "system":
        spark.conf.set("spark.sql.session.timeZone", str(zone))
    sink = sink or open_sink(spark, {"type": definition.sink.type, **definition.sink.options})
    evolution = SchemaEvolution(definition.config["schema.change.behavior"], list(definition.sink.include) if definition.sink.include else None, list(definition.sink.exclude) if definition.sink.exclude is not None else None)
    for table, (changes, schema) in planned(spark, definition, sink=sink).tables.items():
        evolution.arrive(Change(table, "create.table", schema=schema), table, sink.apply)
        if not sink.lazy:  # counted as the rows are written, at no extra pass
            changes, sink.seen[str(table)] = observed(changes, f"{definition.config['name']}: {table}")
        sink.write(table, changes, schema, batch)
    return sink
