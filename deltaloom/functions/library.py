"""The scalar functions of the transform language by name: each takes the compiler, the argument trees and columns."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.exprs.types import INTEGERS, MOST_DIGITS, capped
from deltaloom.functions import temporal as D
from deltaloom.functions.casts import is_zoned
from deltaloom.package import ship

FUNCTIONS: dict[str, Callable[..., Column]] = {}


def function(*names: str) -> Callable:
    def add(made: Callable) -> Callable:
        FUNCTIONS.update(dict.fromkeys(names, made))
        return made

    return add


def plain(name: str, made: Callable[..., Column]) -> None:
    FUNCTIONS[name] = lambda compiler, trees, *cols: made(*cols)


def text(compiler: object, c: Column) -> Column:
    """As a string, for functions on texts."""
    from deltaloom.functions.casts import text_of

    kind = compiler.type_of(c)
    return c if isinstance(kind, T.StringType) else text_of(c, kind)


def same(compiler: object, c: Column, out: Column) -> Column:
    """out in c's own kind; a decimal's in scale 0."""
    kind = compiler.type_of(c)
    return out.cast(T.DecimalType(min(38, kind.precision - kind.scale + (kind.scale > 0)) or 1, 0)) if isinstance(kind, T.DecimalType) else out.cast(kind)


# texts


@function("CONCAT")
def concat(compiler, trees, *cols):
    return F.concat(*[F.coalesce(text(compiler, c), F.lit("null")) for c in cols])


@function("CONCAT_WS")
def concat_ws(compiler, trees, separator, *cols):
    parts = F.filter(F.array(*[text(compiler, c) for c in cols]), lambda x: x.isNotNull())
    return F.when(separator.isNotNull(), F.call_function("array_join", parts, separator)) if cols else F.when(separator.isNotNull(), F.lit(""))


@function("CHAR_LENGTH", "CHARACTER_LENGTH", "LENGTH")
def char_length(compiler, trees, c):
    return F.length(c)


plain("UPPER", F.upper)
plain("LOWER", F.lower)


@function("TRIM")
def trim(compiler, trees, c, *rest):
    return F.regexp_replace(c, F.lit("^[\\x00-\\x20]+|[\\x00-\\x20]+$"), F.lit(""))


def trimmer(made: Callable) -> Callable:
    def run(compiler, trees, c, chars=None):
        return made(c) if chars is None else F.when(chars == "", c).otherwise(made(c, chars))

    return run


for _name, _made in (("LTRIM", F.ltrim), ("RTRIM", F.rtrim), ("BTRIM", F.btrim)):
    FUNCTIONS[_name] = trimmer(_made)


def pattern_of(trees: list, at: int) -> str | None:
    return trees[at][1] if trees[at][0] == "string" else None


def valid_regex(pattern: str | None) -> bool:
    """Whether a constant pattern is one; what isn't constant is left to run time."""
    if pattern is None:
        return True
    import re

    try:
        re.compile(re.sub(r"\(\?<(?![=!])", "(?P<", pattern).replace("\\p{", "[{"))
        return True
    except (re.error, RecursionError):
        return "\\p" in pattern or "++" in pattern or "*+" in pattern


@function("REGEXP_REPLACE")
def regexp_replace(compiler, trees, c, pattern, replacement):
    if not valid_regex(pattern_of(trees, 1)):
        return F.lit(None).cast("string")
    literal = F.replace(F.replace(replacement, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.regexp_replace(c, pattern, literal)


@function("REGEXP_EXTRACT")
def regexp_extract(compiler, trees, c, pattern, group=None):
    if not valid_regex(pattern_of(trees, 1)):
        return F.lit(None).cast("string")
    return F.when(F.rlike(c, pattern), F.call_function("regexp_extract", c, pattern, F.lit(0) if group is None else group))


@function("REGEXP_EXTRACT_ALL")
def regexp_extract_all(compiler, trees, c, pattern, group=None):
    if not valid_regex(pattern_of(trees, 1)):
        return F.lit(None).cast("array<string>")
    return F.regexp_extract_all(c, pattern, F.lit(1) if group is None else group)


@function("REGEXP_COUNT")
def regexp_count(compiler, trees, c, pattern):
    return F.regexp_count(c, pattern) if valid_regex(pattern_of(trees, 1)) else F.lit(None).cast("int")


@function("REGEXP_INSTR")
def regexp_instr(compiler, trees, c, pattern):
    return F.call_function("regexp_instr", c, pattern) if valid_regex(pattern_of(trees, 1)) else F.lit(None).cast("int")


@function("REGEXP_SUBSTR")
def regexp_substr(compiler, trees, c, pattern):
    return F.regexp_substr(c, pattern) if valid_regex(pattern_of(trees, 1)) else F.lit(None).cast("string")


@function("REGEXP")
def regexp(compiler, trees, c, pattern):
    return F.rlike(c, pattern)


@function("SUBSTR", "SUBSTRING")
def substring(compiler, trees, c, begin, length=None):
    begin = begin.cast("int")
    start = F.when(begin == 0, 1).when(begin < 0, F.length(c) + begin + 1).otherwise(begin)
    size = F.lit(2147483647) if length is None else F.when(length < 0, F.raise_error(F.lit("a substring can't be shorter than 0"))).otherwise(length.cast("int"))
    empty = F.lit("") if not isinstance(compiler.type_of(c), T.BinaryType) else F.lit(b"")
    return F.when(c.isNull() | begin.isNull(), F.lit(None)).when(start < 1, empty).otherwise(F.substr(c, start, size))


@function("OVERLAY")
def overlay(compiler, trees, c, part, begin, length=None):
    size = F.length(part) if length is None else length.cast("int")
    begin = begin.cast("int")
    head = F.substr(c, F.lit(1), begin - 1)
    rest = F.when(size < 0, F.substr(c, F.lit(1), F.lit(0))).otherwise(F.substr(c, begin + size))
    return F.when((begin < 1) | (begin > F.length(c)), c).otherwise(F.concat(head, part, rest))


@function("POSITION", "LOCATE")
def position(compiler, trees, seek, c, begin=None):
    begin = F.lit(1) if begin is None else F.greatest(begin.cast("int"), F.lit(1))
    if isinstance(compiler.type_of(c), T.BinaryType):  # bytes as characters
        seek, c = F.decode(seek, "ISO-8859-1"), F.decode(c, "ISO-8859-1")
    return F.when(F.length(seek) == 0, F.when(c.isNotNull(), F.lit(1))).otherwise(F.call_function("locate", seek, c, begin))


@function("INSTR")
def instr(compiler, trees, c, seek):
    return F.call_function("instr", c, seek)


def padded(made: str) -> Callable:
    def run(compiler, trees, c, size, pad=None):
        pad = F.lit(" ") if pad is None else pad
        return F.when((size < 0) | (pad == ""), F.lit(None).cast("string")).otherwise(F.call_function(made, c, size.cast("int"), pad))

    return run


FUNCTIONS["LPAD"], FUNCTIONS["RPAD"] = padded("lpad"), padded("rpad")


@function("REPLACE")
def replace(compiler, trees, c, seek, now):
    between = F.concat(F.call_function("array_join", F.concat(F.array(F.lit("")), F.split(c, "")), now), F.when(F.length(c) > 0, now).otherwise(F.lit("")))
    return F.when(seek == "", F.when(F.length(c) == 0, now).otherwise(between)).otherwise(F.replace(c, seek, now))


@function("REPEAT")
def repeat(compiler, trees, c, times):
    return F.call_function("repeat", c, F.greatest(times.cast("int"), F.lit(0)))


@function("LEFT")
def left(compiler, trees, c, size):
    return F.left(c, F.greatest(size.cast("int"), F.lit(0)))


@function("RIGHT")
def right(compiler, trees, c, size):
    return F.right(c, F.greatest(size.cast("int"), F.lit(0)))


plain("STARTSWITH", F.startswith)
plain("ENDSWITH", F.endswith)
plain("TO_BASE64", lambda c: F.base64(c.cast("binary")))
plain("FROM_BASE64", lambda c: F.decode(F.unbase64(c), "UTF-8"))
plain("FROM_BASE64_BINARY", F.unbase64)
plain("REVERSE", F.reverse)


@function("UUID")
def uuid(compiler, trees, c=None):
    """A random one, or the name-based (version 3) one of some bytes."""
    if c is None:
        return F.expr("uuid()")
    h = F.md5(c.cast("binary"))
    third = F.concat(F.lit("3"), F.substr(h, F.lit(14), F.lit(3)))
    variant = F.substr(F.lit("89ab"), (F.conv(F.substr(h, F.lit(17), F.lit(1)), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat_ws("-", F.substr(h, F.lit(1), F.lit(8)), F.substr(h, F.lit(9), F.lit(4)), third, F.concat(variant, F.substr(h, F.lit(18), F.lit(3))), F.substr(h, F.lit(21), F.lit(12)))


# numbers


@function("ABS")
def absolute(compiler, trees, c):
    kind = compiler.type_of(c)
    return F.abs(c).try_cast(capped(kind.precision, kind.scale)) if isinstance(kind, T.DecimalType) else F.abs(c).cast(kind)


@function("CEIL", "CEILING")
def ceiling(compiler, trees, c):
    return same(compiler, c, F.ceil(c)) if not isinstance(compiler.type_of(c), T.FloatType | T.DoubleType) else (F.ceil(c)).cast(compiler.type_of(c))


@function("FLOOR")
def floor(compiler, trees, c):
    return same(compiler, c, F.floor(c)) if not isinstance(compiler.type_of(c), T.FloatType | T.DoubleType) else (F.floor(c)).cast(compiler.type_of(c))


@function("ROUND")
def rounded(compiler, trees, c, places=None):
    kind = compiler.type_of(c)
    out = F.call_function("round", c, F.lit(0) if places is None else places)
    if not isinstance(kind, T.DecimalType):
        return out.cast(kind)
    made = compiler.type_of(out)
    return out.try_cast(capped(made.precision, made.scale)) if made.precision > MOST_DIGITS else out


# conditions


@function("COALESCE")
def coalesce(compiler, trees, *cols):
    return F.coalesce(*cols)


@function("IF")
def if_(compiler, trees, condition, yes, no):
    return F.when(F.coalesce(condition, F.lit(False)), yes).otherwise(no)


@function("NULLIF")
def nullif(compiler, trees, a, b):
    return F.when(compiler.compared("=", a, b), F.lit(None)).otherwise(a)


@function("IFNULL", "NVL")
def ifnull(compiler, trees, a, b):
    return F.coalesce(a, b)


# dates and times

FUNCTIONS["CURRENT_DATE"] = lambda compiler, trees: F.current_date()
FUNCTIONS["CURRENT_TIMESTAMP"] = FUNCTIONS["NOW"] = lambda compiler, trees: F.current_timestamp()
FUNCTIONS["LOCALTIMESTAMP"] = lambda compiler, trees: F.localtimestamp()
FUNCTIONS["LOCALTIME"] = FUNCTIONS["CURRENT_TIME"] = lambda compiler, trees: F.call_function("current_time", F.lit(0))


@function("EXTRACT")
def extract(compiler, trees, unit, c):
    return D.extracted(trees[0][1], c, compiler.type_of(c))


def field(unit: str) -> Callable:
    return lambda compiler, trees, c: D.extracted(unit, c, compiler.type_of(c))


for _name, _unit in (("YEAR", "YEAR"), ("QUARTER", "QUARTER"), ("MONTH", "MONTH"), ("WEEK", "WEEK"), ("DAYOFYEAR", "DOY"), ("DAYOFMONTH", "DAY"), ("DAYOFWEEK", "DOW"), ("HOUR", "HOUR"), ("MINUTE", "MINUTE"), ("SECOND", "SECOND")):
    FUNCTIONS[_name] = field(_unit)


@function("TIMESTAMPADD", "TIMESTAMP_ADD")
def timestampadd(compiler, trees, unit, n, c):
    kind = compiler.type_of(c)
    moved = D.shifted(c, kind, n, trees[0][1])
    return F.date_trunc("MILLISECOND", moved).cast(kind) if isinstance(kind, T.TimestampType | T.TimestampNTZType) else moved


@function("TIMESTAMPDIFF", "TIMESTAMP_DIFF")
def timestampdiff(compiler, trees, unit, a, b):
    return D.difference(trees[0][1], a, b)


@function("DATE_FORMAT")
def date_format(compiler, trees, c, pattern):
    return D.formatted(c, compiler.type_of(c), pattern)


@function("DATE_FORMAT_TZ")
def date_format_tz(compiler, trees, c, *rest):
    pattern = rest[0] if len(rest) > 1 else F.lit("yyyy-MM-dd HH:mm:ss")
    return D.formatted_in(c, compiler.type_of(c), pattern, rest[-1])


@function("TO_DATE")
def to_date(compiler, trees, c, pattern=None):
    kind = compiler.type_of(c)
    if is_zoned(kind):
        return F.convert_timezone(F.current_timezone(), c["zone"], c["ts"].cast("timestamp_ntz")).cast("date")
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz")).cast("date")
    if isinstance(kind, T.StringType):
        return F.call_function("try_to_date", c, F.lit("yyyy-MM-dd") if pattern is None else pattern)
    return c.cast("date")


@function("TO_TIMESTAMP")
def to_timestamp(compiler, trees, c, pattern=None):
    return F.call_function("to_timestamp_ntz", c, F.lit("yyyy-MM-dd HH:mm:ss") if pattern is None else pattern)


@function("TO_TIMESTAMP_LTZ")
def to_timestamp_ltz(compiler, trees, c, *rest):
    """From a text, in UTC unless a zone is given; from seconds (precision 0) or milliseconds (3)."""
    if isinstance(compiler.type_of(c), T.StringType):
        local = F.call_function("to_timestamp_ntz", c, rest[0] if rest else F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
        return F.convert_timezone(rest[1] if len(rest) > 1 else F.lit("UTC"), F.current_timezone(), local).cast("timestamp")
    precision = trees[1][1] if len(trees) > 1 else "3"
    if precision not in ("0", "3"):
        raise ValueError("a number of seconds (0) or milliseconds (3) is needed")
    return F.timestamp_seconds(c) if precision == "0" else F.timestamp_millis(c.cast("bigint"))


@function("FROM_UNIXTIME")
def from_unixtime(compiler, trees, c, pattern=None):
    return F.call_function("date_format", F.timestamp_seconds(c), F.lit("yyyy-MM-dd HH:mm:ss") if pattern is None else pattern)


@function("UNIX_TIMESTAMP")
def unix_timestamp(compiler, trees, c=None, pattern=None):
    if c is None:
        return F.unix_timestamp(F.current_timestamp())
    read = F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss") if pattern is None else pattern)
    return F.coalesce(F.unix_timestamp(read), F.lit(-(1 << 63)).cast("bigint"))


@function("DATE_ADD")
def date_add(compiler, trees, c, days):
    return F.date_format(F.date_add(c.cast("date"), days.cast("int")), "yyyy-MM-dd")


# JSON


def last_of_each_key(c: Column) -> Column:
    """JSON texts with the last value of each key; what isn't JSON stays for the parser to reject."""
    ship()

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(json.loads(text), ensure_ascii=False)
        except ValueError:
            return text

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(c)


def parsed(made: Callable) -> Callable:
    """An empty text is NULL. Keys may repeat only if asked for (a second argument TRUE): the last one counts."""

    def run(compiler, trees, c, duplicates=None):
        c = text(compiler, c)
        repeat = duplicates is not None and trees[1] == ("literal", True)
        return made(F.when(c != "", last_of_each_key(c) if repeat else c))

    return run


FUNCTIONS["PARSE_JSON"], FUNCTIONS["TRY_PARSE_JSON"] = parsed(F.parse_json), parsed(F.try_parse_json)

__all__ = ["FUNCTIONS", "INTEGERS", "function"]
