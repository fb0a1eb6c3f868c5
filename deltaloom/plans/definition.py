"""Pipeline definitions: YAML text to checked dataclasses."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

import yaml

from deltaloom.operators.evolve import BEHAVIORS
from deltaloom.operators.route import RouteRule
from deltaloom.operators.transform import TransformRule, names_of, options_of

TOP = {"source", "sink", "route", "transform", "pipeline"}
KEYS = {
    "transform": {"source-table", "projection", "filter", "primary-keys", "partition-keys", "table-options", "table-options.delimiter", "description", "converter-after-transform"},
    "route": {"source-table", "sink-table", "replace-symbol", "description"},
    "udf": {"name", "classpath", "options"},
    "model": {"model-name", "class-name"},
}
PIPELINE = {
    "name": "Pipeline job", "parallelism": 1, "execution.runtime-mode": "STREAMING", "schema.change.behavior": "LENIENT", "route-mode": "ALL_MATCH", "local-time-zone": "system",
    "operator.uid.prefix": None, "schema.operator.uid": None, "schema-operator.rpc-timeout": "3 min", "partition.strategy": None,
}


class DefinitionError(ValueError):
    """A pipeline definition that doesn't hold."""


@dataclass(frozen=True)
class UdfDef:
    name: str
    classpath: str
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class ModelDef:
    name: str
    class_name: str
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class EndDef:
    """A source or a sink: its type, name and options; a sink also takes schema changes selectively."""

    type: str
    name: str | None
    options: Mapping[str, object]
    include: tuple[str, ...] | None = None
    exclude: tuple[str, ...] | None = None


@dataclass(frozen=True)
class PipelineDef:
    sources: tuple[EndDef, ...]
    sink: EndDef
    routes: tuple[RouteRule, ...] = ()
    transforms: tuple[TransformRule, ...] = ()
    udfs: tuple[UdfDef, ...] = ()
    models: tuple[ModelDef, ...] = ()
    config: Mapping[str, object] = field(default_factory=lambda: dict(PIPELINE))

    @property
    def streaming(self) -> bool:
        return self.config["execution.runtime-mode"] == "STREAMING"


def _mapping(value: object, what: str) -> dict:
    if not isinstance(value, dict):
        raise DefinitionError(f"{what} must be a mapping")
    return value


def _list(value: object, what: str) -> list:
    if value is None:
        return []
    if not isinstance(value, list):
        raise DefinitionError(f"{what} must be an array")
    return [_mapping(x, f"an entry of {what}") for x in value]


def _known(entry: dict, kind: str, required: set[str]) -> dict:
    if extra := set(entry) - KEYS[kind] - ({*entry} if kind == "model" else set()):
        raise DefinitionError(f"unexpected key {sorted(extra)[0]!r} in {kind}; one of {', '.join(sorted(KEYS[kind]))}")
    if missing := sorted(required - {k for k, v in entry.items() if v is not None}):
        raise DefinitionError(f"missing key {missing[0]!r} in {kind}")
    return entry


def _end(entry: object, what: str) -> EndDef:
    entry = dict(_mapping(entry, what))
    if not entry.get("type"):
        raise DefinitionError(f"missing key 'type' in {what}")
    tags = lambda k: tuple(map(str, x if isinstance(x, list) else [x])) if (x := entry.pop(k, None)) is not None else None
    include, exclude = tags("include.schema.changes"), tags("exclude.schema.changes")
    if what == "source" and (include or exclude):
        raise DefinitionError("only a sink includes or excludes schema changes")
    return EndDef(str(entry.pop("type")), entry.pop("name", None), entry | {}, include, exclude)


def zone(text: str) -> str:
    """A region or a fixed offset; abbreviations are ambiguous."""
    if text == "system":
        return text
    if re.fullmatch(r"(GMT|UTC)?[+-]\d{1,2}(:\d{2})?", text) or text in ("UTC", "GMT", "Z"):
        return text
    try:
        ZoneInfo(text)
    except Exception as wrong:
        raise DefinitionError(f"not a time zone: {text!r}") from wrong
    if "/" not in text:
        raise DefinitionError(f"not a time zone: {text!r}")
    return text


def parse(text: str, config: Mapping[str, object] | None = None) -> PipelineDef:
    """A definition; config is the global configuration, under the definition's own pipeline section."""
    try:
        root = _mapping(yaml.safe_load(text), "a pipeline definition")
    except yaml.YAMLError as wrong:
        raise DefinitionError(f"not YAML: {wrong}") from wrong
    if extra := set(root) - TOP:
        raise DefinitionError(f"unexpected key {sorted(extra)[0]!r}; one of {', '.join(sorted(TOP))}")
    for end in ("source", "sink"):
        if end not in root:
            raise DefinitionError(f"missing {end}")
    sources = root["source"] if isinstance(root["source"], list) else [root["source"]]
    if not sources:
        raise DefinitionError("missing source")
    transforms = []
    for entry in _list(root.get("transform"), "transform"):
        _known(entry, "transform", {"source-table"})
        transforms.append(
            TransformRule(
                str(entry["source-table"]), _text(entry.get("projection")), _text(entry.get("filter")), names_of(_text(entry.get("primary-keys"))), names_of(_text(entry.get("partition-keys"))),
                options_of(_text(entry.get("table-options")) or "", str(entry.get("table-options.delimiter", ","))), _text(entry.get("converter-after-transform")), _text(entry.get("description")),
            )
        )
    routes = []
    for entry in _list(root.get("route"), "route"):
        _known(entry, "route", {"source-table", "sink-table"})
        routes.append(RouteRule(str(entry["source-table"]), str(entry["sink-table"]), _text(entry.get("replace-symbol")), _text(entry.get("description"))))
    own = _mapping(root.get("pipeline") or {}, "pipeline")
    udfs = tuple(UdfDef(str(e["name"]), str(e["classpath"]), dict(e.get("options") or {})) for e in map(lambda e: _known(e, "udf", {"name", "classpath"}), _list(own.get("user-defined-function"), "user-defined-function")))
    models = tuple(ModelDef(str(e["model-name"]), str(e["class-name"]), {k: str(v) for k, v in e.items() if k not in KEYS["model"]}) for e in map(lambda e: _known(e, "model", {"model-name", "class-name"}), _list(own.get("model"), "model")))
    merged = {**PIPELINE, **(config or {}), **{k: v for k, v in own.items() if k not in ("user-defined-function", "model")}}
    for key, allowed in (("schema.change.behavior", BEHAVIORS), ("route-mode", ("ALL_MATCH", "FIRST_MATCH")), ("execution.runtime-mode", ("STREAMING", "BATCH")), ("partition.strategy", ("PRIMARY_KEY", "TABLE_ID", "SINK_DEFINED", None))):
        if merged[key] is not None:
            merged[key] = str(merged[key]).upper()
        if merged[key] not in allowed:
            raise DefinitionError(f"{key} can't be {merged[key]!r}; one of {', '.join(str(x) for x in allowed)}")
    merged["local-time-zone"] = zone(str(merged["local-time-zone"]))
    return PipelineDef(tuple(_end(s, "source") for s in sources), _end(root["sink"], "sink"), tuple(routes), tuple(transforms), udfs, models, merged)


def _text(value: object) -> str | None:
    return None if value is None else str(value).lower() if isinstance(value, bool) else str(value)
