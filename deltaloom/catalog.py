"""Tables, their schemas and types, and what schema changes and merges make of them: plain Python, no Spark."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

FINEST, WIDEST_DECIMAL = 9, 38


@dataclass(frozen=True, order=True)
class TableId:
    """One to three dotted parts: namespace, schema, table."""

    parts: tuple[str, ...]

    @classmethod
    def parse(cls, text: str) -> TableId:
        parts = tuple(text.split("."))
        if not 1 <= len(parts) <= 3 or not all(parts):
            raise ValueError(f"a table has one to three dotted parts: {text!r}")
        return cls(parts)

    @property
    def table(self) -> str:
        return self.parts[-1]

    @property
    def schema(self) -> str | None:
        return self.parts[-2] if len(self.parts) > 1 else None

    @property
    def namespace(self) -> str | None:
        return self.parts[0] if len(self.parts) > 2 else None

    def __str__(self) -> str:
        return ".".join(self.parts)


@dataclass(frozen=True)
class Type:
    """A type of the data model: root, arguments (lengths, precision, element types) and whether it takes NULL."""

    root: str
    args: tuple = ()
    nullable: bool = True

    def __str__(self) -> str:
        shown = f"({', '.join(map(str, self.args))})" if self.args and self.root not in ("ARRAY", "MAP", "ROW") else ""
        if self.root in ("ARRAY", "MAP", "ROW"):
            shown = "<" + ", ".join(f"{x[0]} {x[1]}" if isinstance(x, tuple) else str(x) for x in self.args) + ">"
        return self.root + shown + ("" if self.nullable else " NOT NULL")

    @classmethod
    def parse(cls, text: str) -> Type:
        text, nullable = text.strip(), True
        if m := re.fullmatch(r"(.*?)\s+(NOT\s+)?NULL", text, re.I | re.S):
            text, nullable = m[1], not m[2]
        m = re.fullmatch(r"(\w+)(?:\s*\(([\d,\s]*)\)|\s*<(.*)>)?", text, re.S)
        if not m:
            raise ValueError(f"not a type: {text!r}")
        root = {"INTEGER": "INT", "DEC": "DECIMAL", "NUMERIC": "DECIMAL", "BOOL": "BOOLEAN"}.get(m[1].upper(), m[1].upper())
        if root not in ROOTS:
            raise ValueError(f"not a type: {text!r}")
        if m[3] is not None:
            inner = _split(m[3])
            return cls(root, tuple((x.split(None, 1)[0], cls.parse(x.split(None, 1)[1])) for x in inner) if root == "ROW" else tuple(map(cls.parse, inner)), nullable)
        args = tuple(int(x) for x in m[2].split(",")) if m[2] and m[2].strip() else ()
        if root == "DECIMAL":
            args = (args + (10, 0)[len(args) :])[:2]
        if root in TIMESTAMPS and not args:
            args = (6,)
        if root == "TIME" and not args:
            args = (0,)
        return cls(root, args, nullable)

    def required(self) -> Type:
        return replace(self, nullable=False)

    def optional(self) -> Type:
        return replace(self, nullable=True)

    def spark(self) -> T.DataType:
        if self.root == "DECIMAL":
            return T.DecimalType(*self.args)
        if self.root == "ARRAY":
            return T.ArrayType(self.args[0].spark(), self.args[0].nullable)
        if self.root == "MAP":
            return T.MapType(self.args[0].spark(), self.args[1].spark(), self.args[1].nullable)
        if self.root == "ROW":
            return T.StructType([T.StructField(n, t.spark(), t.nullable) for n, t in self.args])
        if self.root == "TIMESTAMP_TZ":
            return T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("zone", T.StringType())])
        if self.root == "TIME":
            return T.TimeType(min(6, self.args[0]))
        return ROOTS[self.root]()

    @classmethod
    def of(cls, kind: T.DataType, nullable: bool = True) -> Type:
        """The model's type of a Spark type."""
        if isinstance(kind, T.DecimalType):
            return cls("DECIMAL", (kind.precision, kind.scale), nullable)
        if isinstance(kind, T.ArrayType):
            return cls("ARRAY", (cls.of(kind.elementType, kind.containsNull),), nullable)
        if isinstance(kind, T.MapType):
            return cls("MAP", (cls.of(kind.keyType, False), cls.of(kind.valueType, kind.valueContainsNull)), nullable)
        if isinstance(kind, T.StructType):
            return cls("ROW", tuple((f.name, cls.of(f.dataType, f.nullable)) for f in kind), nullable)
        if kind.typeName() == "time":
            return cls("TIME", (6,), nullable)
        names = {T.BooleanType: "BOOLEAN", T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT", T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.StringType: "STRING", T.BinaryType: "BYTES", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP_LTZ", T.VariantType: "VARIANT"}
        root = names[type(kind)]
        return cls(root, (6,) if root in TIMESTAMPS else (), nullable)


TIMESTAMPS = ("TIMESTAMP", "TIMESTAMP_LTZ", "TIMESTAMP_TZ")
ROOTS = {
    "BOOLEAN": T.BooleanType, "TINYINT": T.ByteType, "SMALLINT": T.ShortType, "INT": T.IntegerType, "BIGINT": T.LongType, "FLOAT": T.FloatType, "DOUBLE": T.DoubleType,
    "DECIMAL": None, "CHAR": T.StringType, "VARCHAR": T.StringType, "STRING": T.StringType, "BINARY": T.BinaryType, "VARBINARY": T.BinaryType, "BYTES": T.BinaryType,
    "DATE": T.DateType, "TIME": None, "TIMESTAMP": T.TimestampNTZType, "TIMESTAMP_LTZ": T.TimestampType, "TIMESTAMP_TZ": None, "ARRAY": None, "MAP": None, "ROW": None,
    "VARIANT": T.VariantType,
}
INTEGERS = ("TINYINT", "SMALLINT", "INT", "BIGINT")
INTEGER_DIGITS = dict(zip(INTEGERS, (3, 5, 10, 19), strict=True))


def _split(text: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            out.append(text[at:i].strip())
            at = i + 1
    return [*out, text[at:].strip()]


@dataclass(frozen=True)
class Column:
    name: str
    type: Type
    comment: str | None = None
    default: str | None = None


@dataclass(frozen=True)
class Schema:
    columns: tuple[Column, ...]
    primary_keys: tuple[str, ...] = ()
    partition_keys: tuple[str, ...] = ()
    options: dict = field(default_factory=dict, hash=False)
    comment: str | None = None

    @classmethod
    def of(cls, *columns: tuple[str, str] | Column, keys: Iterable[str] = (), **more: object) -> Schema:
        made = tuple(c if isinstance(c, Column) else Column(c[0], Type.parse(c[1])) for c in columns)
        return cls(made, tuple(keys), **more).keyed(tuple(keys))

    def keyed(self, keys: tuple[str, ...]) -> Schema:
        """The same with these primary keys, whose columns take no NULL."""
        missing = [k for k in keys if k not in self.names]
        if missing:
            raise ValueError(f"no columns {missing} for the primary key")
        return replace(self, primary_keys=tuple(keys), columns=tuple(replace(c, type=c.type.required()) if c.name in keys else c for c in self.columns))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def __getitem__(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)

    def get(self, name: str) -> Column | None:
        return next((c for c in self.columns if c.name == name), None)

    def spark(self) -> T.StructType:
        """As a Spark schema; comments, defaults and lengths stand in the fields' metadata."""
        return T.StructType([T.StructField(c.name, c.type.spark(), c.type.nullable, {"type": str(c.type)} | ({"comment": c.comment} if c.comment else {}) | ({"default": c.default} if c.default else {})) for c in self.columns])

    @classmethod
    def from_spark(cls, schema: T.StructType, keys: Iterable[str] = ()) -> Schema:
        return cls(tuple(Column(f.name, Type.of(f.dataType, f.nullable), f.metadata.get("comment"), f.metadata.get("default")) for f in schema)).keyed(tuple(keys))


# Widening


def wider(kind: Type) -> list[Type]:
    """What a type widens to, nearest first: itself, then along its family, at last STRING."""
    root, text = kind.root, Type("STRING")
    if root in INTEGERS:
        ladder = [Type(r) for r in INTEGERS[INTEGERS.index(root) :]]
        return [*ladder, Type("DECIMAL", (WIDEST_DECIMAL, 0)), *([Type("FLOAT")] if root in ("TINYINT", "SMALLINT") else []), Type("DOUBLE"), text]
    if root in ("FLOAT", "DOUBLE"):
        return [*([Type("FLOAT")] if root == "FLOAT" else []), Type("DOUBLE"), text]
    if root in TIMESTAMPS or root == "DATE":
        rest = TIMESTAMPS[TIMESTAMPS.index(root) :] if root != "DATE" else TIMESTAMPS
        return [*([Type("DATE")] if root == "DATE" else []), *(Type(r, (FINEST,)) for r in rest), text]
    return [text]


def bounded_decimal(precision: int, scale: int) -> Type:
    """A decimal of so many digits; past the widest, digits go from the right."""
    over = max(0, precision - WIDEST_DECIMAL)
    return Type("DECIMAL", (precision - over, scale - over))


def least_common_type(a: Type, b: Type) -> Type:
    nullable = a.nullable or b.nullable
    return replace(_common(a.optional(), b.optional()), nullable=nullable)


def _common(a: Type, b: Type) -> Type:
    if a == b:
        return a
    if a.root in TIMESTAMPS and b.root in TIMESTAMPS:
        return Type(TIMESTAMPS[max(TIMESTAMPS.index(a.root), TIMESTAMPS.index(b.root))], (max(a.args[0], b.args[0]),))
    if "DECIMAL" in (a.root, b.root):
        x, y = (a, b) if a.root == "DECIMAL" else (b, a)
        if y.root == "DECIMAL":
            scale = max(x.args[1], y.args[1])
            return bounded_decimal(max(x.args[0] - x.args[1], y.args[0] - y.args[1]) + scale, scale)
        if y.root in INTEGERS:
            return bounded_decimal(max(x.args[0], x.args[1] + INTEGER_DIGITS[y.root]), x.args[1])
        return Type("STRING")
    other = wider(b)
    return next((t for t in wider(a) if t in other), Type("STRING"))


def is_compatible(current: Schema | None, upcoming: Schema) -> bool:
    """Whether current holds each upcoming column in a type that it widens to."""
    if current is None:
        return False
    for c in upcoming.columns:
        own = current.get(c.name)
        if own is None:
            return False
        a, b = own.type.optional(), c.type.optional()
        if a != b and a not in wider(b) and not (a.root in TIMESTAMPS and b.root in TIMESTAMPS and _common(a, b) == a) and not (a.root == "DECIMAL" and (b.root == "DECIMAL" or b.root in INTEGERS) and _common(a, b) == a):
            return False
    return True


def least_common_schema(current: Schema | None, upcoming: Schema) -> Schema:
    """Shared columns widened in place, new ones appended in their order."""
    if current is None:
        return upcoming
    shared = [replace(c, type=least_common_type(c.type, upcoming[c.name].type)) if upcoming.get(c.name) else c for c in current.columns]
    return replace(current, columns=(*shared, *(c for c in upcoming.columns if c.name not in current.names)))


# Schema changes


@dataclass(frozen=True)
class Change:
    """A schema change of a table: kind is create.table, add.column, alter.column.type, drop.column, rename.column,
    drop.table, truncate.table or table.comment; detail depends on it."""

    table: TableId
    kind: str
    schema: Schema | None = None
    added: tuple[tuple[Column, str, str | None], ...] = ()  # column, FIRST | LAST | BEFORE | AFTER, anchor
    types: tuple[tuple[str, Type], ...] = ()
    dropped: tuple[str, ...] = ()
    renamed: tuple[tuple[str, str], ...] = ()
    comment: str | None = None


KINDS = ("create.table", "add.column", "alter.column.type", "drop.column", "rename.column", "drop.table", "truncate.table", "table.comment")


def apply_change(schema: Schema | None, change: Change) -> Schema | None:
    if change.kind == "create.table":
        return change.schema
    if schema is None:
        raise ValueError(f"{change.table} has no schema yet")
    if change.kind == "add.column":
        columns = list(schema.columns)
        for column, where, anchor in change.added:
            if column.name in [c.name for c in columns]:
                raise ValueError(f"{change.table} already has a column {column.name}")
            names = [c.name for c in columns]
            if where in ("BEFORE", "AFTER") and anchor not in names:
                raise ValueError(f"{change.table} has no column {anchor}")
            place = {"FIRST": 0, "LAST": len(columns)}.get(where)
            columns.insert(names.index(anchor) + (where == "AFTER") if place is None else place, column)
        return replace(schema, columns=tuple(columns))
    if change.kind == "alter.column.type":
        now = dict(change.types)
        return replace(schema, columns=tuple(replace(c, type=now[c.name]) if c.name in now else c for c in schema.columns))
    if change.kind == "drop.column":
        return replace(schema, columns=tuple(c for c in schema.columns if c.name not in change.dropped))
    if change.kind == "rename.column":
        now = dict(change.renamed)
        return replace(schema, columns=tuple(replace(c, name=now.get(c.name, c.name)) for c in schema.columns), primary_keys=tuple(now.get(k, k) for k in schema.primary_keys), partition_keys=tuple(now.get(k, k) for k in schema.partition_keys))
    return replace(schema, comment=change.comment) if change.kind == "table.comment" else schema


def is_redundant(schema: Schema | None, change: Change) -> bool:
    """Whether a change has been applied already; truncation and comments never have."""
    if change.kind == "create.table":
        return schema is not None
    if schema is None:
        return change.kind == "drop.table"
    if change.kind == "add.column":
        return all(c.name in schema.names for c, _, _ in change.added)
    if change.kind == "alter.column.type":
        return all(schema.get(n) is not None and schema[n].type == t for n, t in change.types)
    if change.kind == "drop.column":
        return not any(n in schema.names for n in change.dropped)
    if change.kind == "rename.column":
        return all(a not in schema.names and b in schema.names for a, b in change.renamed)
    return False


def difference(table: TableId, before: Schema | None, after: Schema) -> list[Change]:
    """The changes that lead from one schema to another: columns added after their neighbours, types, columns dropped."""
    if before is None:
        return [Change(table, "create.table", schema=after)]
    out, added = [], []
    for i, c in enumerate(after.columns):
        if c.name not in before.names:
            added.append((c, "AFTER", after.columns[i - 1].name) if i else (c, "FIRST", None))
    types = tuple((c.name, c.type) for c in after.columns if before.get(c.name) and before[c.name].type != c.type)
    dropped = tuple(c.name for c in before.columns if c.name not in after.names)
    if added:
        out.append(Change(table, "add.column", added=tuple(added)))
    if types:
        out.append(Change(table, "alter.column.type", types=types))
    if dropped:
        out.append(Change(table, "drop.column", dropped=dropped))
    return out


def transformed_change(change: Change, wildcard: bool, referenced: list[str]) -> Change | None:
    """What a projection lets through. Without a wildcard columns are fixed, and only types of referenced ones change;
    with one, first and last place are next to the outermost referenced columns."""
    if change.kind not in ("add.column", "alter.column.type", "drop.column", "rename.column"):
        return change
    if wildcard:
        if change.kind != "add.column" or not referenced:
            return change
        moved = tuple((c, "BEFORE", referenced[0]) if w == "FIRST" else (c, "AFTER", referenced[-1]) if w == "LAST" else (c, w, a) for c, w, a in change.added)
        return replace(change, added=moved)
    if change.kind == "alter.column.type":
        kept = tuple((n, t) for n, t in change.types if n in referenced)
        return replace(change, types=kept) if kept else None
    return None


def lenient(schema: Schema, change: Change) -> list[Change]:
    """A change that keeps what a sink has: a dropped column stays, NULL from now on and no longer required; a renamed
    one stays and a new one comes; table removals are dropped."""
    table = change.table
    if change.kind in ("drop.table", "truncate.table"):
        return []
    if change.kind == "drop.column":
        loose = tuple((n, schema[n].type.optional()) for n in change.dropped if schema.get(n) and not schema[n].type.nullable)
        return [Change(table, "alter.column.type", types=loose)] if loose else []
    if change.kind == "rename.column":
        new = tuple((Column(b, schema[a].type.optional(), schema[a].comment), "LAST", None) for a, b in change.renamed)
        loose = tuple((a, schema[a].type.optional()) for a, _ in change.renamed if not schema[a].type.nullable)
        return [Change(table, "add.column", added=new), *([Change(table, "alter.column.type", types=loose)] if loose else [])]
    if change.kind == "add.column":
        return [replace(change, added=tuple((replace(c, type=c.type.optional()), "LAST", None) for c, _, _ in change.added))]
    return [change]


FAMILIES = {
    "all": set(KINDS), "add": {"add.column"}, "alter": {"alter.column.type", "table.comment"}, "create": {"create.table"}, "drop": {"drop.column", "drop.table"},
    "rename": {"rename.column"}, "truncate": {"truncate.table"}, "table": {"create.table", "drop.table", "truncate.table", "table.comment"},
    "column": {"add.column", "alter.column.type", "drop.column", "rename.column"},
}


def accepted_kinds(include: list[str] | None, exclude: list[str] | None, behavior: str = "LENIENT") -> set[str]:
    """The kinds a sink takes: exclusion wins, create.table is always in; by default the lenient behaviour excludes
    dropping and truncating tables."""
    def kinds(tags: list[str]) -> set[str]:
        out = set()
        for tag in tags:
            found = FAMILIES.get(tag) or ({tag} if tag in KINDS else set())
            if not found:
                raise ValueError(f"no schema change {tag!r}; one of {', '.join([*FAMILIES, *KINDS])}")
            out |= found
        return out

    taken = kinds(include) if include else set(KINDS)
    if exclude is None and behavior == "LENIENT":
        exclude = ["drop.table", "truncate.table"]
    return taken - kinds(exclude or []) | {"create.table"}
