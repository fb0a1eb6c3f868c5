"""Names of the language's types and the Spark types that stand for them."""

from __future__ import annotations

from pyspark.sql import types as T

SIMPLE = {
    "BOOLEAN": T.BooleanType(), "TINYINT": T.ByteType(), "SMALLINT": T.ShortType(), "INT": T.IntegerType(), "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(), "FLOAT": T.FloatType(), "DOUBLE": T.DoubleType(), "CHAR": T.StringType(), "VARCHAR": T.StringType(), "STRING": T.StringType(),
    "BINARY": T.BinaryType(), "VARBINARY": T.BinaryType(), "BYTES": T.BinaryType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampNTZType(),
    "TIMESTAMP_LTZ": T.TimestampType(),
}
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REALS = (T.FloatType, T.DoubleType)
#: Decimal results of expressions hold at most so many digits.
MOST_DIGITS = 19


def rank(kind: T.DataType) -> int:
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.FloatType, T.DoubleType]
    return next((i for i, t in enumerate(order) if isinstance(kind, t)), -1)


def capped(precision: int, scale: int) -> T.DecimalType:
    precision = min(MOST_DIGITS, max(1, precision))
    return T.DecimalType(precision, min(scale, precision))


def digits(kind: T.DataType) -> T.DecimalType:
    """The decimal that holds an integer type."""
    if isinstance(kind, T.DecimalType):
        return capped(kind.precision, kind.scale)
    return T.DecimalType({T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}[type(kind)], 0)


def arithmetic_type(op: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of a op b. Integers keep the wider type, reals the wider real; decimals follow the usual rules, cut to
    MOST_DIGITS digits."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
        return T.DoubleType()
    if isinstance(a, T.FloatType) or isinstance(b, T.FloatType):
        return T.DoubleType() if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType) else T.FloatType()
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return a if rank(a) >= rank(b) else b
    x, y = digits(a), digits(b)
    if op in "+-":
        scale = max(x.scale, y.scale)
        precision = max(x.precision - x.scale, y.precision - y.scale) + scale + 1
    elif op == "*":
        scale, precision = x.scale + y.scale, x.precision + y.precision
    elif op == "/":
        scale = max(6, x.scale + y.precision + 1)
        whole = x.precision - x.scale + y.scale
        precision = whole + scale
        if precision > MOST_DIGITS:
            scale = max(MOST_DIGITS - whole, 0)
    else:
        scale = max(x.scale, y.scale)
        precision = min(x.precision - x.scale, y.precision - y.scale) + scale
    return capped(precision, scale)


def named(name: str, args: list[int]) -> T.DataType:
    """The Spark type of a type name in a cast."""
    if name in ("DECIMAL", "DEC", "NUMERIC"):
        return capped(args[0] if args else 10, args[1] if len(args) > 1 else 0)
    if name not in SIMPLE:
        raise ValueError(f"can't cast to {name}")
    return SIMPLE[name]
