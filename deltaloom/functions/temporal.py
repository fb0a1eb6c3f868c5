"""Dates and times: the language's interval arithmetic and units on Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONTHS = {"MONTH": 1, "QUARTER": 3, "YEAR": 12, "DECADE": 120, "CENTURY": 1200}
MICROS = {"MICROSECOND": 1, "MILLISECOND": 1_000, "SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000, "DAY": 86_400_000_000, "WEEK": 604_800_000_000}
DAY = MICROS["DAY"]


def is_time(kind: T.DataType) -> bool:
    return kind.typeName() == "time"


def micros_of_day(c: Column) -> Column:
    return F.call_function("time_diff", F.lit("MICROSECOND"), F.lit("00:00:00").cast("time(6)"), c)


def shifted(c: Column, kind: T.DataType, number: int | Column, unit: str) -> Column:
    """c plus so many units. Months of a local-zone timestamp count in UTC, a time wraps at midnight and knows no
    months, a date moves by whole days only."""
    n = number if isinstance(number, Column) else F.lit(number)
    if unit in MONTHS:
        months = (n * MONTHS[unit]).cast("int")
        if is_time(kind):
            return c
        if isinstance(kind, T.DateType):
            return F.add_months(c, months)
        if isinstance(kind, T.TimestampType):
            utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz")) + F.make_interval(months=months)
            return F.convert_timezone(F.lit("UTC"), F.current_timezone(), utc).cast("timestamp")
        return c + F.make_interval(months=months)
    if unit not in MICROS:
        raise ValueError(f"no interval of {unit}")
    micros = n.cast("bigint") * MICROS[unit]
    if isinstance(kind, T.DateType):
        return F.date_add(c, F.call_function("div", micros, F.lit(DAY)).cast("int"))
    if is_time(kind):
        moved = F.pmod(micros_of_day(c) + micros, F.lit(DAY))
        return F.call_function("make_time", F.call_function("div", moved, F.lit(MICROS["HOUR"])).cast("int"), F.pmod(F.call_function("div", moved, F.lit(MICROS["MINUTE"])), F.lit(60)).cast("int"), (F.pmod(moved, F.lit(MICROS["MINUTE"])) / 1_000_000).cast("decimal(16,6)"))
    return c + F.make_dt_interval(secs=(micros.cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)"))


def extracted(unit: str, c: Column, kind: T.DataType) -> Column:
    """A field as BIGINT. A date has no hours, minutes or seconds: 0; a time has no date: an error."""
    clock = unit in ("HOUR", "MINUTE", "SECOND", "MILLISECOND")
    if is_time(kind) and not clock:
        raise ValueError(f"a time has no {unit}")
    if isinstance(kind, T.DateType) and clock:
        return F.when(c.isNotNull(), F.lit(0).cast("bigint"))
    if isinstance(kind, T.StringType):
        c = c.cast("timestamp_ntz")
    fields = {"SECOND": F.second, "MINUTE": F.minute, "HOUR": F.hour, "WEEK": F.weekofyear}
    if unit in fields:
        return fields[unit](c).cast("bigint")
    if unit == "MILLISECOND":
        return (F.second(c) * 1000 + F.date_format(c, "SSS").cast("int")).cast("bigint")
    spark_unit = {"DOW": "DOW", "ISODOW": "DOW_ISO", "ISOYEAR": "YEAROFWEEK"}.get(unit, unit)
    if unit == "EPOCH":
        return F.unix_timestamp(c.cast("timestamp")).cast("bigint")
    if unit in ("DECADE", "CENTURY", "MILLENNIUM"):
        size = {"DECADE": 10, "CENTURY": 100, "MILLENNIUM": 1000}[unit]
        return (F.floor(F.year(c) / 10) if unit == "DECADE" else F.ceil(F.year(c) / size)).cast("bigint")
    return F.date_part(F.lit(spark_unit), c).cast("bigint")


def difference(unit: str, a: Column, b: Column) -> Column:
    """b - a in whole units, cut towards zero from whole seconds; months, quarters and years by calendar fields; NULL
    beyond 32 bits."""
    if unit in MONTHS:
        months = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
        out = F.year(b) - F.year(a) if unit == "YEAR" else months if unit == "MONTH" else F.call_function("div", months.cast("bigint"), F.lit(MONTHS[unit]).cast("bigint"))
        return out.cast("bigint").try_cast("int")
    if unit not in MICROS:
        raise ValueError(f"no difference in {unit}")
    seconds = lambda c: F.floor(F.unix_micros(c.cast("timestamp_ntz").cast("timestamp")) / 1_000_000)
    if unit == "MILLISECOND":
        return F.call_function("div", F.unix_micros(b.cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(a.cast("timestamp_ntz").cast("timestamp")), F.lit(1000).cast("bigint")).try_cast("int")
    size = MICROS[unit] // 1_000_000
    return F.call_function("div", seconds(b) - seconds(a), F.lit(size).cast("bigint")).try_cast("int")


def formatted(c: Column, kind: T.DataType, pattern: Column) -> Column:
    if is_time(kind):  # Spark doesn't format times: stand it on a day
        c = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=(micros_of_day(c).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)"))
    elif isinstance(kind, T.StringType):
        c = c.cast("timestamp_ntz")
    return F.call_function("date_format", c, pattern)


def formatted_in(c: Column, kind: T.DataType, pattern: Column, zone: Column) -> Column:
    """A local-zone timestamp printed in a zone; one without a zone is read in it, which prints it unchanged."""
    if isinstance(kind, T.TimestampType):
        c = F.convert_timezone(F.current_timezone(), zone, c.cast("timestamp_ntz"))
    return F.call_function("date_format", c, pattern)
