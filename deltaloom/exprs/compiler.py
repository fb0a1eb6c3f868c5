"""Syntax trees to Spark columns.

The language differs from Spark SQL in places, and each is encoded here or in the function library: comparisons with
NULL are false (<> is true), LIKE without ESCAPE finds a regular expression, integers divide to integers, decimals keep
at most 19 digits, casts of numbers wrap and casts of junk give NULL, subscripts count from 1. Types come from the
schema and from Spark's own analysis of the partial columns, so nothing is run."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.exprs import types as K
from deltaloom.exprs.grammar import ParseError, parse_expression, parse_projection, referenced


def false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


class Compiler:
    """Compiles trees against a schema. columns maps names to columns that stand for them; udfs maps names to callables
    from argument columns (and their types) to a column, and goes before the built-in functions."""

    def __init__(self, spark: SparkSession, schema: T.StructType, columns: Mapping[str, Column] | None = None, udfs: Mapping[str, Callable] | None = None, zone: str | None = None) -> None:
        self.spark, self.schema = spark, schema
        self.columns = dict(columns or {f.name: F.col(f"`{f.name}`") for f in schema})
        self.udfs = {k.lower(): v for k, v in (udfs or {}).items()}
        self.zone = zone or spark.conf.get("spark.sql.session.timeZone")
        self.empty: DataFrame = spark.createDataFrame([], schema)
        self.seen: dict[str, T.DataType] = {}

    def type_of(self, c: Column) -> T.DataType:
        key = str(c)
        if key not in self.seen:
            try:
                self.seen[key] = self.empty.select(c.alias("x")).schema[0].dataType
            except Exception as failed:
                raise ParseError(f"not a valid expression: {str(failed).splitlines()[0]}") from failed
        return self.seen[key]

    def compile(self, text: str) -> Column:
        c = self.column(parse_expression(text))
        self.type_of(c)
        return c

    def column(self, tree: tuple) -> Column:
        return getattr(self, f"_{tree[0]}")(*tree[1:])

    def passing(self, tree: tuple) -> Column:
        """A condition that is true where the tree is; elsewhere it may be NULL."""
        if tree[0] in ("and", "or") and not may_fail(tree):
            x, y = self.passing(tree[1]), self.passing(tree[2])
            return x & y if tree[0] == "and" else x | y
        if tree[0] == "compare" and not may_fail(tree):
            x, y = self.column(tree[2]), self.column(tree[3])
            if tree[1] == "<>":
                nulls = [c.isNull() for c, t in ((x, tree[2]), (y, tree[3])) if t[0] not in ("number", "string")]
                return functools.reduce(operator.or_, nulls, x != y)
            return {"=": x == y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[tree[1]]
        if tree[0] == "between" and not may_fail(tree):
            return self.column(tree[1]).between(self.column(tree[2]), self.column(tree[3]))
        if tree[0] == "in" and tree[2] and not may_fail(tree):
            return self.column(tree[1]).isin([self.column(x) for x in tree[2]])
        return self.column(tree)

    # leaves

    def _literal(self, value: object) -> Column:
        return F.lit(value)

    def _string(self, value: str) -> Column:
        return F.lit(value)

    def _number(self, text: str) -> Column:
        if "e" in text.lower():
            return F.lit(float(text))
        if "." in text:
            whole, _, part = text.partition(".")
            precision = max(1, len((whole + part).lstrip("0")), len(part))
            return F.lit(text).cast(T.DecimalType(min(38, precision), len(part)))
        value = int(text)
        if abs(value) < 1 << 31:
            return F.lit(value)
        return F.lit(value).cast("bigint") if abs(value) < 1 << 63 else F.lit(text).cast(T.DecimalType(min(38, len(text)), 0))

    def _temporal(self, kind: str, text: str) -> Column:
        return F.lit(text).cast({"DATE": "date", "TIMESTAMP": "timestamp_ntz", "TIME": "time(6)"}[kind])

    def _column(self, name: str) -> Column:
        if name not in self.columns:
            raise ParseError(f"column {name!r} is not present in the table; it has {', '.join(self.columns)}")
        return self.columns[name]

    def _field(self, owner: tuple, name: str) -> Column:
        return self.column(owner)[name]

    def _interval(self, number: int, unit: str) -> Column:
        raise ParseError("an interval can only be added to or subtracted from a date or time")

    # operators

    def _and(self, a: tuple, b: tuple) -> Column:
        x, y = self.column(a), self.column(b)
        # where b may fail it mustn't be looked at for nothing; elsewhere a plain AND, which Spark can split and push
        return F.when(~x, F.lit(False)).otherwise(x & y) if may_fail(b) else x & y

    def _or(self, a: tuple, b: tuple) -> Column:
        x, y = self.column(a), self.column(b)
        return F.when(x, F.lit(True)).otherwise(x | y) if may_fail(b) else x | y

    def _not(self, a: tuple) -> Column:
        return ~self.column(a)

    def _is(self, test: str, a: tuple) -> Column:
        c = self.column(a)
        return c.isNull() if test in ("NULL", "UNKNOWN") else c.eqNullSafe(F.lit(test == "TRUE"))

    def _distinct(self, a: tuple, b: tuple) -> Column:
        return ~self.column(a).eqNullSafe(self.column(b))

    def compared(self, op: str, x: Column, y: Column) -> Column:
        if op == "<>":
            return ~false_if_null(x == y)
        return false_if_null({"=": x == y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op])

    def _compare(self, op: str, a: tuple, b: tuple) -> Column:
        return self.compared(op, self.column(a), self.column(b))

    def _between(self, a: tuple, low: tuple, high: tuple) -> Column:
        return false_if_null(self.column(a).between(self.column(low), self.column(high)))

    def _in(self, a: tuple, items: list) -> Column:
        return false_if_null(self.column(a).isin([self.column(x) for x in items])) if items else F.lit(False)

    def _like(self, a: tuple, pattern: tuple, escape: tuple | None) -> Column:
        if escape is None:
            return F.rlike(self.column(a), self.column(pattern))
        if is_null(pattern) or is_null(escape):
            return F.lit(None).cast("boolean")
        return F.like(self.column(a), self.column(pattern), F.lit(self.constant(escape)))

    def _similar(self, a: tuple, pattern: tuple, escape: tuple | None) -> Column:
        if is_null(pattern) or escape is not None and is_null(escape):
            return F.lit(None).cast("boolean")
        return F.rlike(self.column(a), F.lit(similar_regex(self.constant(pattern), self.constant(escape) if escape else None)))

    def constant(self, tree: tuple) -> str:
        if tree[0] != "string":
            raise ParseError("a pattern and its escape must be string literals here")
        return tree[1]

    def _negate(self, a: tuple) -> Column:
        if a[0] == "number":
            return self._number("-" + a[1]) if "e" in a[1].lower() or "." not in a[1] and abs(int(a[1])) < 1 << 63 else -self.column(a)
        c = self.column(a)
        return (-c).cast(self.type_of(c))

    def _arithmetic(self, op: str, a: tuple, b: tuple) -> Column:
        from deltaloom.functions.temporal import shifted

        if b[0] == "interval" and op in "+-":
            c = self.column(a)
            return shifted(c, self.type_of(c), b[1] if op == "+" else -b[1], b[2])
        if a[0] == "interval" and op == "+":
            c = self.column(b)
            return shifted(c, self.type_of(c), a[1], a[2])
        x, y = self.column(a), self.column(b)
        p, q = self.type_of(x), self.type_of(y)
        if isinstance(p, T.StringType) or isinstance(q, T.StringType):
            raise ParseError(f"no arithmetic on strings: {op}")
        kind = K.arithmetic_type(op, p, q)
        if isinstance(kind, K.INTEGERS):
            wide = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply}
            if op in wide:
                return wrapped(wide[op](x.cast("decimal(38,0)"), y.cast("decimal(38,0)")), kind)
            # a zero divisor fails the query, as integers do; Spark's own % and div keep the dividend's sign
            return (F.call_function("div", x.cast("bigint"), y.cast("bigint")) if op == "/" else x % y).cast(kind)
        if isinstance(kind, T.DecimalType):
            x, y = (c if isinstance(t, T.DecimalType) else c.cast(K.digits(t)) for c, t in ((x, p), (y, q)))
            out = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "/": F.try_divide, "%": F.try_mod}[op](x, y)
            return out.try_cast(kind)
        x, y = x.cast(kind), y.cast(kind)
        if op == "/":  # reals divide by zero to infinity or NaN
            zero = F.when(x == 0, F.lit(float("nan"))).otherwise(F.when(x > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf"))))
            return F.when(y == 0, zero).otherwise(F.try_divide(x, y)).cast(kind)
        return {"+": x + y, "-": x - y, "*": x * y, "%": F.try_mod(x, y)}[op].cast(kind)

    def _case(self, subject: tuple | None, branches: list, other: tuple) -> Column:
        out, on = None, None if subject is None else self.column(subject)
        for test, result in branches:
            when = false_if_null(self.column(test)) if on is None else self.compared("=", on, self.column(test))
            out = F.when(when, self.column(result)) if out is None else out.when(when, self.column(result))
        return out.otherwise(self.column(other))

    def _cast(self, a: tuple, target: tuple) -> Column:
        from deltaloom.functions.casts import cast

        c = self.column(a)
        try:
            return cast(c, self.type_of(c), K.named(*target))
        except ValueError as wrong:
            raise ParseError(str(wrong)) from wrong

    def _item(self, owner: tuple, index: tuple) -> Column:
        c = self.column(owner)
        kind = self.type_of(c)
        if isinstance(kind, T.ArrayType):
            return F.get(c, self.column(index).cast("int") - 1)
        if isinstance(kind, T.MapType):
            return F.try_element_at(c, self.column(index).cast(kind.keyType))
        if isinstance(kind, T.StructType):
            if index[0] != "number" or not index[1].isdigit() or not 1 <= int(index[1]) <= len(kind):
                raise ParseError(f"a row's subscript must be a constant from 1 to {len(kind)}")
            return c.getField(kind[int(index[1]) - 1].name)
        if isinstance(kind, T.VariantType):
            if index[0] == "number" and index[1].isdigit():
                return F.try_variant_get(c, f"$[{int(index[1]) - 1}]", "variant") if int(index[1]) else F.lit(None).cast("variant")
            key = self.constant(index).replace("\\", "\\\\").replace('"', '\\"')
            return F.try_variant_get(c, f'$["{key}"]', "variant")
        raise ParseError(f"no subscripts on {kind.simpleString()}")

    def _call(self, name: str, args: list) -> Column:
        from deltaloom.functions.library import FUNCTIONS

        udf = self.udfs.get(name.lower())
        if udf is not None:
            cols = [self.column(a) for a in args]
            return udf(*cols, types=[self.type_of(c) for c in cols])
        made = FUNCTIONS.get(name.upper())
        if made is None:
            raise ParseError(f"no function {name}")
        cols = [self.column(a) for a in args]
        try:
            return made(self, args, *cols)
        except TypeError as wrong:
            if "argument" not in str(wrong):
                raise
            raise ParseError(f"{name} doesn't take {len(args)} arguments") from wrong


def is_null(tree: tuple) -> bool:
    return tree == ("literal", None) or tree[0] == "cast" and is_null(tree[1])


def may_fail(tree: object) -> bool:
    """Whether evaluating a tree can fail a query: integer division, strict parsing, user functions."""
    if not isinstance(tree, tuple | list):
        return False
    if tree and tree[0] == "arithmetic" and tree[1] in "/%":
        return True
    if tree and tree[0] == "cast" and isinstance(tree[2], tuple) and tree[2][0] == "TIMESTAMP":
        return True
    if tree and tree[0] == "call" and str(tree[1]).upper() in ("TO_TIMESTAMP", "TO_TIMESTAMP_LTZ", "PARSE_JSON", "SUBSTRING"):
        return True
    return any(may_fail(x) for x in tree)


def wrapped(value: Column, kind: T.DataType) -> Column:
    """An exact integer in a decimal, in two's complement of the type."""
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(kind)]
    half, whole = F.lit(str(1 << bits - 1)).cast("decimal(38,0)"), F.lit(str(1 << bits)).cast("decimal(38,0)")
    inside = value.between(-half, half - 1)
    turned = F.pmod(value + half, whole) - half
    return F.when(inside, value).otherwise(turned).cast(kind)


def similar_regex(pattern: str, escape: str | None) -> str:
    """A SIMILAR TO pattern as an anchored regular expression."""
    out, i, bracket = [], 0, False
    while i < len(pattern):
        c = pattern[i]
        if escape and c == escape:
            i += 1
            if i == len(pattern):
                raise ParseError(f"the escape ends the pattern {pattern!r}")
            out.append("\\" + pattern[i] if not pattern[i].isalnum() else pattern[i])
        elif bracket:
            bracket = c != "]"
            out.append(c if c != "\\" else "\\\\")
        elif c == "[":
            bracket = True
            out.append(c)
        elif c in "%_":
            out.append("(?s:.*)" if c == "%" else "(?s:.)")
        elif c in "|*+?{}()":
            out.append(c)
        else:
            out.append("\\" + c if c in ".^$\\]" else c)
        i += 1
    return "^(?:" + "".join(out) + ")$"


def compile_projection(compiler: Compiler, text: str | None, hidden: set[str] = frozenset()) -> dict[str, Column]:
    """Output columns by name, in order. A wildcard stands for the physical columns; a name that comes again replaces
    the earlier one in its place. hidden: metadata columns, which no alias may take."""
    out: dict[str, Column] = {}
    explicit: set[str] = set()
    for tree, alias in parse_projection(text):
        if tree is None:
            for f in compiler.schema:
                if f.name not in hidden:
                    out[f.name] = compiler.columns[f.name]
            continue
        if tree[0] != "column":
            if alias in hidden:
                raise ParseError(f"{alias} is the name of a metadata column")
            if alias in explicit:
                raise ParseError(f"the name {alias} is computed twice")
            explicit.add(alias)
        made = compiler.column(tree)
        compiler.type_of(made)
        meta = compiler.schema[tree[1]].metadata if tree[0] == "column" and tree[1] in compiler.schema.names else None
        out[alias] = made.alias(alias, metadata=meta) if meta else made
    return out


def compile_filter(compiler: Compiler, text: str | None) -> Column | None:
    """The filter, None when it is empty. A NULL outcome of it counts as false, so comparisons at its top need no guard
    against NULL and can be pushed to the scan."""
    if not text or not text.strip():
        return None
    tree = parse_expression(text)
    c = compiler.passing(tree)
    if not isinstance(compiler.type_of(compiler.column(tree)), T.BooleanType | T.NullType):
        raise ParseError(f"a filter must be BOOLEAN: {text}")
    return c.cast("boolean") if isinstance(compiler.type_of(c), T.NullType) else c


__all__ = ["Compiler", "compile_filter", "compile_projection", "referenced"]
