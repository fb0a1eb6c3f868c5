"""Casts of the transform language: numbers wrap or saturate as a narrowing does, junk becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER = r"^\s*[+-]?\d+\s*$"
#: What a text must look like to be a double: to try and fail costs far more than to look.
NUMBER = r"(?i)^[\x00-\x20]*[+-]?(\d+\.?\d*(e[+-]?\d+)?[df]?|\.\d+(e[+-]?\d+)?[df]?|nan|inf|infinity)[\x00-\x20]*$"


def cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    if isinstance(target, T.StringType):
        return text_of(c, source)
    if isinstance(target, T.BooleanType):
        if isinstance(source, T.StringType):
            return F.lower(c) == "true"
        return c != 0 if isinstance(source, T.NumericType) else c.cast("boolean")
    if isinstance(target, T.ByteType | T.ShortType | T.IntegerType | T.LongType):
        return integer(c, source, target)
    if isinstance(target, T.FloatType | T.DoubleType):
        return c.cast("int").cast(target) if isinstance(source, T.BooleanType) else number(c, source).try_cast(target)
    if isinstance(target, T.DecimalType):
        return decimal(c, source, target)
    if isinstance(target, T.TimestampNTZType):
        return stamp(c, source)
    if target == source:
        return c
    raise ValueError(f"can't cast {source.simpleString()} to {target.simpleString()}")


def text_of(c: Column, source: T.DataType) -> Column:
    """Dates and times as ISO texts, a timestamp with T between them and no trailing zeros."""
    if is_zoned(source):
        local = F.convert_timezone(F.lit("UTC"), c["zone"], F.convert_timezone(F.current_timezone(), F.lit("UTC"), c["ts"].cast("timestamp_ntz")))
        minutes = F.timestamp_diff("MINUTE", F.convert_timezone(F.current_timezone(), F.lit("UTC"), c["ts"].cast("timestamp_ntz")), local)
        sign = F.when(minutes < 0, "-").otherwise("+")
        offset = F.when(minutes == 0, "Z").otherwise(F.format_string("%s%02d:%02d", sign, F.floor(F.abs(minutes) / 60), F.abs(minutes) % 60))
        return F.concat(text_of(local, T.TimestampNTZType()), offset)
    if isinstance(source, T.TimestampNTZType | T.TimestampType):
        return F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
    return F.base64(c) if isinstance(source, T.BinaryType) else c.cast("string")


def integer(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """An exact parse first; else through a double, narrowed: to 32 or 64 bits by saturation, then to fewer by wrapping."""
    if isinstance(source, T.BooleanType):
        return c.cast("int").cast(target)
    exact = F.when(F.rlike(c, F.lit(INTEGER)), F.trim(c).try_cast(target)) if isinstance(source, T.StringType) else c.try_cast(target) if isinstance(source, T.ByteType | T.ShortType | T.IntegerType | T.LongType) else None
    bits = 64 if isinstance(target, T.LongType) else 32
    low, high = -float(1 << bits - 1), float((1 << bits - 1) - (bits == 32))
    kind = "bigint" if bits == 64 else "int"
    # what isn't a number is out, so the bounds meet no NULL; below 2^63 the next double is 1024 less
    known = F.rlike(c, F.lit(NUMBER)) if isinstance(source, T.StringType) else c.isNotNull()
    inside = F.greatest(F.least(F.nanvl(c.try_cast("double"), F.lit(0.0)), F.lit(high)), F.lit(low))
    whole = F.when(known, inside.cast(kind) if bits == 32 else F.when(inside >= high, F.lit((1 << 63) - 1)).otherwise(F.least(inside, F.lit(high - 1024)).cast(kind)))
    if isinstance(target, T.ByteType | T.ShortType):
        half = 128 if isinstance(target, T.ByteType) else 32768
        whole = (F.pmod(whole.cast("bigint") + half, F.lit(2 * half)) - half).cast(target)
    return whole if exact is None else F.coalesce(exact, whole)


def decimal(c: Column, source: T.DataType, target: T.DecimalType) -> Column:
    """Rounded half up to the scale; NULL where the digits don't fit."""
    if isinstance(source, T.BooleanType):
        return c.cast("int").cast(target)
    return F.round(number(c, source).try_cast(T.DecimalType(38, min(18, target.scale + 10))), target.scale).try_cast(target)


def number(c: Column, source: T.DataType) -> Column:
    """c, without texts that are no number."""
    return F.when(F.rlike(c, F.lit(NUMBER)), c) if isinstance(source, T.StringType) else c


def is_zoned(kind: T.DataType) -> bool:
    """Whether a type stands for a timestamp with its own zone."""
    return isinstance(kind, T.StructType) and kind.names == ["ts", "zone"]


def stamp(c: Column, source: T.DataType) -> Column:
    """A timestamp; a text that isn't one fails the query."""
    if isinstance(source, T.StringType):
        return F.replace(c, F.lit("T"), F.lit(" ")).cast("timestamp_ntz")
    if is_zoned(source):
        return c["ts"].cast("timestamp_ntz")
    if isinstance(source, T.NullType):
        return c.cast("timestamp_ntz")
    if isinstance(source, T.DateType | T.TimestampType | T.TimestampNTZType):
        return c.cast("timestamp_ntz")
    raise ValueError(f"can't cast {source.simpleString()} to timestamp")
