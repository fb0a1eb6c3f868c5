"""What sinks write: message formats of changes, and how the model's types become a sink's."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.catalog import Schema, TableId, Type

KEEP_NULLS = {"ignoreNullFields": "false"}


def json(c: Column) -> Column:
    return F.to_json(c, KEEP_NULLS)


def debezium_json(changes: DataFrame, table: TableId, with_schema: bool = False, schema: Schema | None = None) -> DataFrame:
    """value: {before, after, op (c, u or d), source {db, table}}, wrapped as schema and payload if asked; updates of a
    replacement count as c."""
    op = F.when(F.col("op").isin("INSERT", "REPLACE"), "c").when(F.col("op") == "UPDATE", "u").otherwise("d")
    source = F.struct(F.lit(table.schema or table.namespace).alias("db"), F.lit(table.table).alias("table"))
    payload = F.struct("before", "after", op.alias("op"), source.alias("source"))
    if not with_schema:
        return changes.withColumn("value", json(payload))
    shown = schema or Schema.from_spark(changes.schema["after"].dataType)
    side = lambda name: F.struct(
        F.lit("struct").alias("type"), F.array(*[F.struct(F.lit(kafka_type(c.type)[0]).alias("type"), F.lit(c.type.nullable).alias("optional"), F.lit(c.name).alias("field"), F.lit(kafka_type(c.type)[1]).alias("name")) for c in shown.columns]).alias("fields"),
        F.lit(True).alias("optional"), F.lit(name).alias("field"),
    )
    described = F.struct(F.lit("struct").alias("type"), F.array(side("before"), side("after")).alias("fields"), F.lit(False).alias("optional"))
    return changes.withColumn("value", json(F.struct(described.alias("schema"), payload.alias("payload"))))


def canal_json(changes: DataFrame, table: TableId, keys: Sequence[str] = ()) -> DataFrame:
    """value: {old, data, type, database, table, pkNames}; an update's old row stands in old, a deletion's in data."""
    data = F.array(F.when(F.col("op") == "DELETE", F.col("before")).otherwise(F.col("after")))
    old = F.when(F.col("op") == "UPDATE", F.array("before"))
    kind = F.when(F.col("op") == "REPLACE", "INSERT").otherwise(F.col("op"))
    names = F.array(*[F.lit(k) for k in keys]) if keys else F.array().cast("array<string>")
    return changes.withColumn("value", json(F.struct(old.alias("old"), data.alias("data"), kind.alias("type"), F.lit(table.schema or table.namespace).alias("database"), F.lit(table.table).alias("table"), names.alias("pkNames"))))


def message_key(changes: DataFrame, table: TableId, keys: Sequence[str], style: str = "json") -> DataFrame:
    """key: the table's name and the primary key, as JSON or comma-separated."""
    own = [F.coalesce(F.col(f"after.`{k}`"), F.col(f"before.`{k}`")) for k in keys]
    if style == "json":
        return changes.withColumn("key", json(F.struct(F.lit(str(table)).alias("TableId"), *[c.alias(k) for c, k in zip(own, keys, strict=True)])))
    if style == "csv":
        return changes.withColumn("key", F.concat_ws(",", F.lit(str(table)), *[c.cast("string") for c in own]))
    raise ValueError(f"no key format {style}")


def kafka_rows(changes: DataFrame, table: TableId, keys: Sequence[str], value: str = "debezium-json", key: str = "json", topic: str | None = None, mapping: dict[str, str] | None = None, partition: str = "all-to-zero", headers: bool = False) -> DataFrame:
    """topic, key, value (and partition, headers) columns, as Spark's Kafka sink takes them."""
    if value not in ("debezium-json", "canal-json"):
        raise ValueError(f"no value format {value}")
    made = debezium_json(changes, table) if value == "debezium-json" else canal_json(changes, table, keys)
    made = message_key(made, table, keys, key)
    columns = [F.lit((mapping or {}).get(str(table)) or topic or str(table)).alias("topic"), "key", "value"]
    if partition == "all-to-zero":
        columns.append(F.lit(0).alias("partition"))
    elif partition != "hash-by-key":
        raise ValueError(f"no partition strategy {partition}")
    if headers:
        header = lambda k, v: F.struct(F.lit(k).alias("key"), F.lit(v or "").cast("binary").alias("value"))
        columns.append(F.array(header("namespace", table.namespace), header("schemaName", table.schema), header("tableName", table.table)).alias("headers"))
    return made.select(*columns)


def kafka_type(t: Type) -> tuple[str, str | None]:
    """A type in a message's schema, and its semantic name."""
    return {
        "BOOLEAN": ("boolean", None), "TINYINT": ("int16", None), "SMALLINT": ("int16", None), "INT": ("int32", None), "BIGINT": ("int64", None), "FLOAT": ("float", None), "DOUBLE": ("double", None),
        "DECIMAL": ("bytes", "org.apache.kafka.connect.data.Decimal"), "DATE": ("int32", "io.debezium.time.Date"), "TIME": ("int64", "io.debezium.time.MicroTime"),
        "TIMESTAMP": ("int64", "io.debezium.time.MicroTimestamp"), "TIMESTAMP_LTZ": ("string", "io.debezium.time.ZonedTimestamp"), "TIMESTAMP_TZ": ("string", "io.debezium.time.ZonedTimestamp"),
        "BINARY": ("bytes", None), "VARBINARY": ("bytes", None), "BYTES": ("bytes", None),
    }.get(t.root, ("string", None))


# Types: source dialect to model, model to sink


def _sized(t: str) -> tuple[str, tuple[int, ...]]:
    name, _, rest = t.partition("(")
    args = tuple(int(x) for x in rest.split(")")[0].split(",") if x.strip().isdigit()) if rest else ()
    return " ".join((name + rest.partition(")")[2]).upper().split()), args


def from_mysql(text: str, tinyint1_is_boolean: bool = True) -> Type:
    name, args = _sized(text)
    unsigned = any(w in name for w in ("UNSIGNED", "ZEROFILL"))
    root = name.split()[0]
    if root in ("BOOL", "BOOLEAN") or root == "TINYINT" and args == (1,) and tinyint1_is_boolean or root == "BIT" and args in ((), (1,)):
        return Type("BOOLEAN")
    if root in ("DECIMAL", "NUMERIC", "FIXED", "DEC"):
        p, s = (args + (10, 0)[len(args) :])[:2]
        return Type("DECIMAL", (p, s)) if p <= 38 else Type("STRING")
    plain = {
        "TINYINT": ("TINYINT", "SMALLINT"), "SMALLINT": ("SMALLINT", "INT"), "MEDIUMINT": ("INT", "INT"), "INT": ("INT", "BIGINT"), "INTEGER": ("INT", "BIGINT"), "YEAR": ("INT", "INT"),
        "FLOAT": ("FLOAT", "FLOAT"), "REAL": ("DOUBLE", "DOUBLE"), "DOUBLE": ("DOUBLE", "DOUBLE"), "DATE": ("DATE", "DATE"),
    }
    if root in plain:
        return Type(plain[root][unsigned])
    if root in ("BIGINT", "SERIAL"):
        return Type("DECIMAL", (20, 0)) if unsigned or root == "SERIAL" else Type("BIGINT")
    if root in ("TIME", "DATETIME", "TIMESTAMP"):
        return Type({"TIME": "TIME", "DATETIME": "TIMESTAMP", "TIMESTAMP": "TIMESTAMP_LTZ"}[root], args or (0,))
    if root == "BIT":
        return Type("BINARY", ((args[0] + 7) // 8,))
    if root in ("CHAR", "VARCHAR", "BINARY", "VARBINARY"):
        return Type(root, args or (1,))
    if "BLOB" in root:
        return Type("BYTES")
    if "TEXT" in root or root in ("ENUM", "JSON", "GEOMETRY", "POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION"):
        return Type("STRING")
    raise ValueError(f"MySQL type {text} isn't supported")


def from_postgres(text: str, decimal: str = "precise", hstore: str = "json") -> Type:
    name, args = _sized(text)
    root = name.split()[0]
    plain = {
        "BOOLEAN": "BOOLEAN", "BOOL": "BOOLEAN", "SMALLINT": "SMALLINT", "INT2": "SMALLINT", "SMALLSERIAL": "SMALLINT", "INTEGER": "INT", "INT": "INT", "INT4": "INT", "SERIAL": "INT",
        "BIGINT": "BIGINT", "INT8": "BIGINT", "BIGSERIAL": "BIGINT", "OID": "BIGINT", "REAL": "FLOAT", "FLOAT4": "FLOAT", "DOUBLE": "DOUBLE", "FLOAT8": "DOUBLE", "DATE": "DATE", "BYTEA": "BYTES",
    }
    if root in plain:
        return Type(plain[root])
    if root == "BIT":
        return Type("BOOLEAN") if args in ((), (1,)) else Type("BYTES")
    if root in ("NUMERIC", "DECIMAL", "MONEY"):
        if decimal == "string":
            return Type("STRING")
        if decimal == "double":
            return Type("DOUBLE")
        return Type("DECIMAL", (args + (0,))[:2]) if args else Type("DECIMAL", (38, 0))
    if root in ("TIMESTAMP", "TIMESTAMPTZ"):
        return Type("TIMESTAMP_TZ" if root == "TIMESTAMPTZ" or "WITH TIME ZONE" in name else "TIMESTAMP", args or (6,))
    if root in ("TIME", "TIMETZ"):
        return Type("STRING") if root == "TIMETZ" or "WITH TIME ZONE" in name else Type("TIME", args or (6,))
    if root == "INTERVAL":
        return Type("BIGINT")
    if root == "HSTORE":
        return Type("MAP", (Type("STRING", (), False), Type("STRING"))) if hstore == "map" else Type("STRING")
    return Type("STRING")


def from_oracle(text: str) -> Type:
    name, args = _sized(text)
    root = name.split()[0]
    if root in ("NUMBER", "NUMERIC", "DECIMAL"):
        p, s = (args + (38, 0)[len(args) :])[:2]
        return Type("DECIMAL", (p, s)) if s > 0 else Type("BIGINT")
    if root == "TIMESTAMP":
        return Type("TIMESTAMP_LTZ" if "LOCAL" in name else "TIMESTAMP_TZ" if "ZONE" in name else "TIMESTAMP", args or (6,))
    plain = {"DATE": ("TIMESTAMP", (0,)), "FLOAT": ("DOUBLE", ()), "BINARY_DOUBLE": ("DOUBLE", ()), "BINARY_FLOAT": ("FLOAT", ()), "INTERVAL": ("BIGINT", ()), "RAW": ("BYTES", ()), "BLOB": ("BYTES", ())}
    return Type(*plain.get(root, ("STRING", ())))


def from_sqlserver(text: str) -> Type:
    name, args = _sized(text)
    root = name.split()[0]
    if root in ("DECIMAL", "NUMERIC"):
        p, s = (args + (18, 0)[len(args) :])[:2]
        return Type("DECIMAL", (min(p, 38), s)) if p <= 38 else Type("DECIMAL", (38, 0))
    plain = {
        "BIT": ("BOOLEAN",), "TINYINT": ("SMALLINT",), "SMALLINT": ("SMALLINT",), "INT": ("INT",), "BIGINT": ("BIGINT",), "REAL": ("FLOAT",), "FLOAT": ("DOUBLE",), "MONEY": ("DECIMAL", (19, 4)),
        "SMALLMONEY": ("DECIMAL", (10, 4)), "DATE": ("DATE",), "TIME": ("TIME", args or (7,)), "DATETIME": ("TIMESTAMP", (3,)), "SMALLDATETIME": ("TIMESTAMP", (0,)), "DATETIME2": ("TIMESTAMP", args or (7,)),
        "DATETIMEOFFSET": ("TIMESTAMP_LTZ", args or (7,)), "BINARY": ("BYTES",), "VARBINARY": ("BYTES",), "IMAGE": ("BYTES",), "ROWVERSION": ("BYTES",), "TIMESTAMP": ("BYTES",),
    }
    return Type(*plain.get(root, ("STRING",)))


SOURCE_DIALECTS: dict[str, Callable[..., Type]] = {"mysql": from_mysql, "postgres": from_postgres, "oracle": from_oracle, "sqlserver": from_sqlserver, "oceanbase": from_mysql}


def to_doris(t: Type) -> str:
    if t.root in ("CHAR", "VARCHAR"):  # lengths count bytes there
        size = 3 * t.args[0]
        return f"{t.root}({size})" if size <= (255 if t.root == "CHAR" else 65533) else ("VARCHAR(%d)" % size if size <= 65533 else "STRING")
    return {"BINARY": "STRING", "VARBINARY": "STRING", "BYTES": "STRING", "TIME": "STRING", "TIMESTAMP": f"DATETIME({min(6, t.args[0]) if t.args else 6})", "TIMESTAMP_LTZ": f"DATETIME({min(6, t.args[0]) if t.args else 6})", "TIMESTAMP_TZ": f"DATETIME({min(6, t.args[0]) if t.args else 6})"}.get(t.root, str(t.optional()))


def to_starrocks(t: Type, max_bytes: int = 3) -> str:
    if t.root == "CHAR":
        size = max_bytes * t.args[0]
        return f"CHAR({size})" if size <= 255 else f"VARCHAR({min(size, 1048576)})"
    if t.root == "VARCHAR":
        return f"VARCHAR({min(max_bytes * t.args[0], 1048576)})"
    if t.root in ("BINARY", "VARBINARY"):
        return f"VARBINARY({min(t.args[0] if t.args else 1, 1048576)})"
    return {"STRING": "VARCHAR(1048576)", "TIME": "VARCHAR(20)", "TIMESTAMP": "DATETIME", "TIMESTAMP_LTZ": "DATETIME", "TIMESTAMP_TZ": "DATETIME"}.get(t.root, str(t.optional()))


def to_oceanbase(t: Type) -> str:
    if t.root == "CHAR":
        return f"CHAR({t.args[0]})" if t.args[0] <= 256 else f"VARCHAR({t.args[0]})"
    if t.root == "VARCHAR":
        return f"VARCHAR({t.args[0]})" if t.args[0] <= 262144 else "TEXT"
    if t.root in ("BINARY", "VARBINARY"):
        return f"VARBINARY({t.args[0]})" if t.args and t.args[0] <= 1048576 else "LONGBLOB"
    return {"STRING": "TEXT", "BYTES": "LONGBLOB", "TIMESTAMP": "DATETIME", "TIMESTAMP_LTZ": "TIMESTAMP"}.get(t.root, str(t.optional()))


def to_elasticsearch(t: Type) -> str:
    return "STRING" if t.root in ("DECIMAL", "DATE", "TIME", "TIMESTAMP", "TIMESTAMP_LTZ", "TIMESTAMP_TZ", "MAP", "ROW") else str(t.optional())


def to_maxcompute(t: Type) -> str:
    return {"TIME": "STRING", "CHAR": "STRING", "TIMESTAMP": "TIMESTAMP_NTZ", "TIMESTAMP_LTZ": "TIMESTAMP", "ROW": str(t.optional()).replace("ROW", "STRUCT", 1)}.get(t.root, str(t.optional()))


def to_fluss(t: Type) -> str:
    return {"VARCHAR": "STRING", "VARBINARY": "BYTES"}.get(t.root, str(t.optional()))


def to_standard(t: Type) -> str:
    """Types that any SQL database has; texts of unknown length get what the least of them allow."""
    if t.root in ("CHAR", "VARCHAR", "DECIMAL", "DATE", "BIGINT", "SMALLINT", "BOOLEAN"):
        return str(t.optional())
    plain = {"TINYINT": "SMALLINT", "INT": "INTEGER", "FLOAT": "REAL", "DOUBLE": "DOUBLE PRECISION", "TIME": "TIME", "TIMESTAMP": "TIMESTAMP", "TIMESTAMP_LTZ": "TIMESTAMP", "BINARY": "BLOB", "VARBINARY": "BLOB", "BYTES": "BLOB"}
    return plain.get(t.root, "VARCHAR(32672)")


def same_type(t: Type) -> str:
    return str(t.optional())


SINK_DIALECTS: dict[str, Callable[..., str]] = {
    "doris": to_doris, "starrocks": to_starrocks, "oceanbase": to_oceanbase, "elasticsearch": to_elasticsearch, "maxcompute": to_maxcompute, "fluss": to_fluss,
    "iceberg": same_type, "paimon": same_type, "hudi": same_type, "jdbc": to_standard,
}
