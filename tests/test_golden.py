"""Expressions over three records of every type: one of usual values, one of odd ones and one of NULLs.

What is expected follows from the language's rules (README, "Semantics worth knowing"), worked out by hand."""

import datetime as dt
import decimal

import pytest

from deltaloom.exprs import Compiler

D = decimal.Decimal

COLUMNS = (
    "k bigint, flag boolean, b tinyint, s smallint, n int, l bigint, f float, d double, whole decimal(12,0), money decimal(18,3), word string, line string, raw binary, "
    "at timestamp_ntz, day date, hour time, marks array<int>, names array<string>, sizes map<string,int>, lists map<int,array<string>>, place struct<town:string,zip:int>"
)
USUAL = """1L, true, 7Y, 30S, 12, 900L, float(2.5), double(10.25), 31415926BD, 2718.281BD, 'Hafen', 'ships at anchor', cast('tide' as binary),
  timestamp_ntz'2011-03-05 14:25:36.125', date'2011-03-05', time'06:07:08', array(4, 9, 16), array('mast', 'keel'), map('bow', 3, 'stern', 5), map(1, array('a', 'b'), 2, array('c')), named_struct('town', 'Brest', 'zip', 29200)"""
ODD = """-5L, false, -100Y, -30000S, -12, -901L, float(-0.25), double(-1e9), -7BD, -0.5BD, 'Überfahrt', '', cast('ß!' as binary),
  timestamp_ntz'1969-12-31 23:59:59.999999', date'1900-02-28', time'23:59:59', cast(array() as array<int>), array('', null), map('', 0), map(-1, array('z')), named_struct('town', '', 'zip', -1)"""


def records_sql() -> str:
    names = [c.strip().split(" ")[0] for c in COLUMNS.split(", ")]
    kinds = ["map<string,int>" if c.startswith("sizes") else c.strip().split(" ", 1)[1] for c in COLUMNS.split(", ")]
    empty = ", ".join(["0L", *(f"cast(null as {kind})" for kind in kinds[1:])])
    return f"select {', '.join(f'cast(c{i} as {kind}) as {name}' for i, (name, kind) in enumerate(zip(names, kinds, strict=True)))} from values ({USUAL}), ({ODD}), ({empty}) as t({', '.join(f'c{i}' for i in range(len(names)))})"


#: text, type, and value for the usual record, the odd one and the one of NULLs.
CASES = [
    # numbers keep the wider type, integers divide to integers and wrap
    ("n + s", "int", 42, -30012, None), ("l - n", "bigint", 888, -889, None), ("n / 5", "int", 2, -2, None), ("l / 100", "bigint", 9, -9, None), ("l % 7", "bigint", 4, -5, None), ("-n * 3", "int", -36, 36, None), ("f / 2", "float", 1.25, -0.125, None),
    ("d * f", "double", 25.625, 2.5e8, None), ("n + 2147483640", "int", -2147483644, 2147483628, None), ("ABS(b)", "tinyint", 7, 100, None), ("CEIL(f)", "float", 3.0, 0.0, None), ("FLOOR(d)", "double", 10.0, -1e9, None), ("ROUND(d, 1)", "double", 10.3, -1e9, None), ("ROUND(n)", "int", 12, -12, None),
    ("2 * 3 + 4 % 3 - 1", "int", 6, 6, 6), ("2 * (3 + 4)", "int", 14, 14, 14), ("1.25e2 + n", "double", 137.0, 113.0, None),
    # decimals hold 19 digits
    ("whole + CAST(1 AS DECIMAL(3, 0))", "decimal(13,0)", D(31415927), D(-6), None), ("ABS(money)", "decimal(18,3)", D("2718.281"), D("0.500"), None), ("CEIL(money)", "decimal(16,0)", D(2719), D(0), None), ("FLOOR(money)", "decimal(16,0)", D(2718), D(-1), None), ("ROUND(money, 1)", "decimal(17,1)", D("2718.3"), D("-0.5"), None),
    ("CAST(money AS DECIMAL(6, 2))", "decimal(6,2)", D("2718.28"), D("-0.50"), None), ("CAST(money AS DECIMAL(4, 1))", "decimal(4,1)", None, D("-0.5"), None), ("CAST('6.28318' AS DECIMAL(9, 3))", "decimal(9,3)", D("6.283"), D("6.283"), D("6.283")), ("CAST('about 3' AS DECIMAL(9, 3))", "decimal(9,3)", None, None, None),
    # casts narrow, junk is NULL
    ("CAST(s AS TINYINT)", "tinyint", 30, -48, None), ("CAST('70000' AS SMALLINT)", "smallint", 4464, 4464, 4464), ("CAST(word AS BIGINT)", "bigint", None, None, None), ("CAST('8.75' AS INT)", "int", 8, 8, 8), ("CAST('4e12' AS INT)", "int", 2147483647, 2147483647, 2147483647), ("CAST(n AS BOOLEAN)", "boolean", True, True, None), ("CAST('True' AS BOOLEAN)", "boolean", True, True, True),
    ("CAST(flag AS STRING)", "string", "true", "false", None), ("CAST(f AS STRING)", "string", "2.5", "-0.25", None), ("CAST(day AS STRING)", "string", "2011-03-05", "1900-02-28", None), ("CAST(hour AS STRING)", "string", "06:07:08", "23:59:59", None), ("CAST(at AS STRING)", "string", "2011-03-05T14:25:36.125", "1969-12-31T23:59:59.999999", None), ("CAST(CAST(at AS STRING) AS TIMESTAMP(6))", "timestamp_ntz", dt.datetime(2011, 3, 5, 14, 25, 36, 125000), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), None),
    # comparisons with NULL are false, but <> and what is built on it
    ("n > 0", "boolean", True, False, False), ("n <> 12", "boolean", False, True, True), ("n = k", "boolean", False, False, False), ("n BETWEEN 10 AND 20", "boolean", True, False, False), ("n NOT BETWEEN 10 AND 20", "boolean", False, True, True), ("word IN ('Hafen', 'Kai')", "boolean", True, False, False), ("word NOT IN ('Hafen', 'Kai')", "boolean", False, True, True),
    ("n IS NOT DISTINCT FROM CAST(NULL AS INT)", "boolean", False, False, True), ("flag IS NOT TRUE", "boolean", False, True, True), ("flag IS NOT UNKNOWN", "boolean", True, True, False), ("flag OR CAST(NULL AS BOOLEAN)", "boolean", True, None, None), ("(flag AND CAST(NULL AS BOOLEAN)) IS UNKNOWN", "boolean", True, False, True), ("NOT (n > 0 OR l > 0)", "boolean", False, True, True),
    ("n = -99 OR 60 / (n + 99) >= 0", "boolean", True, True, False),
    # patterns
    ("line LIKE 'at'", "boolean", True, False, None), ("line LIKE '^at'", "boolean", False, False, None), ("line LIKE 'ships%' ESCAPE '+'", "boolean", True, False, None), ("'50%' LIKE '50+%' ESCAPE '+'", "boolean", True, True, True), ("line SIMILAR TO '(ship|boat)s?%r'", "boolean", True, False, None), ("word NOT SIMILAR TO 'H_f+en'", "boolean", False, True, None),
    ("REGEXP_REPLACE(line, '[aeiou]+', '_')", "string", "sh_ps _t _nch_r", "", None), ("REGEXP_EXTRACT(line, '(\\w+) at (\\w+)', 2)", "string", "anchor", None, None), ("REGEXP_COUNT(line, 'h')", "int", 2, 0, None), ("REGEXP_INSTR(line, 'a[nt]')", "int", 7, 0, None), ("REGEXP_SUBSTR(line, 'an.')", "string", "anc", None, None), ("REGEXP_EXTRACT_ALL(line, '(.)h')[2]", "string", "c", None, None),
    # texts; || writes NULL out
    ("'[' || word || ']'", "string", "[Hafen]", "[Überfahrt]", "[null]"), ("CONCAT_WS('+', word, NULL, 'x')", "string", "Hafen+x", "Überfahrt+x", "x"), ("CHAR_LENGTH(word)", "int", 5, 9, None), ("UPPER(word) || LOWER(word)", "string", "HAFENhafen", "ÜBERFAHRTüberfahrt", "nullnull"), ("SUBSTRING(line FROM 7)", "string", "at anchor", "", None), ("SUBSTR(word, -3, 2)", "string", "fe", "hr", None),
    ("POSITION('a' IN line FROM 8)", "int", 10, 0, None), ("LOCATE('a', line)", "int", 7, 0, None), ("OVERLAY(word PLACING '**' FROM 2 FOR 3)", "string", "H**n", "Ü**fahrt", None), ("BTRIM('--bow--', '-')", "string", "bow", "bow", "bow"), ("LPAD(word, 7, '.')", "string", "..Hafen", "Überfah", None), ("RPAD('ab', 5, 'xy')", "string", "abxyx", "abxyx", "abxyx"), ("REPLACE(line, 'an', '')", "string", "ships at chor", "", None),
    ("REPEAT(LEFT(word, 1), 3)", "string", "HHH", "ÜÜÜ", None), ("TO_BASE64(raw)", "string", "dGlkZQ==", "w58h", None), ("FROM_BASE64('a2VlbA==')", "string", "keel", "keel", "keel"), ("STARTSWITH(word, 'Ha') AND ENDSWITH(line, 'or')", "boolean", True, False, None),
    # choices
    ("CASE n WHEN 12 THEN 'dozen' WHEN -12 THEN 'debt' ELSE 'none' END", "string", "dozen", "debt", "none"), ("CASE WHEN l > 0 THEN 1 WHEN l < 0 THEN -1 END", "int", 1, -1, None), ("IF(CHAR_LENGTH(word) > 5, 'long', 'short')", "string", "short", "long", "short"), ("COALESCE(n, k, 3)", "bigint", 12, -12, 0), ("NULLIF(n, 12)", "int", None, -12, None),
    # subscripts count from 1
    ("marks[1] + marks[3]", "int", 20, None, None), ("names[marks[1] / 2]", "string", "keel", None, None), ("marks[0]", "int", None, None, None), ("sizes['bow']", "int", 3, None, None), ("lists[1][2]", "string", "b", None, None), ("place[2]", "int", 29200, -1, None), ("place.town", "string", "Brest", "", None),
    ("CAST(PARSE_JSON('{\"crew\": [3, {\"cook\": \"Ada\"}]}')['crew'][2]['cook'] AS STRING)", "string", "Ada", "Ada", "Ada"), ("TRY_PARSE_JSON('[1,') IS NULL", "boolean", True, True, True), ("CAST(PARSE_JSON('{\"a\": 1, \"a\": 9}', TRUE)['a'] AS STRING)", "string", "9", "9", "9"),
    # dates and times
    ("EXTRACT(YEAR FROM at)", "bigint", 2011, 1969, None), ("DAYOFYEAR(day)", "bigint", 64, 59, None), ("DAYOFWEEK(day)", "bigint", 7, 4, None), ("QUARTER(at) * 10 + MONTH(at)", "bigint", 13, 52, None), ("DATE_FORMAT(at, 'dd.MM.yy HH:mm')", "string", "05.03.11 14:25", "31.12.69 23:59", None), ("DATE_FORMAT(hour, 'HH-mm')", "string", "06-07", "23-59", None),
    ("TO_DATE('03/05/2011', 'MM/dd/yyyy')", "date", *[dt.date(2011, 3, 5)] * 3), ("TO_DATE('no day')", "date", None, None, None), ("TO_TIMESTAMP('20110305 1425', 'yyyyMMdd HHmm')", "timestamp_ntz", *[dt.datetime(2011, 3, 5, 14, 25)] * 3), ("FROM_UNIXTIME(l)", "string", "1970-01-01 00:15:00", "1969-12-31 23:44:59", None), ("FROM_UNIXTIME(l, 'mm/ss')", "string", "15/00", "44/59", None),
    ("DATE_ADD(day, 30)", "string", "2011-04-04", "1900-03-30", None), ("day + INTERVAL '1' MONTH", "date", dt.date(2011, 4, 5), dt.date(1900, 3, 28), None), ("day - INTERVAL '30' HOUR", "date", dt.date(2011, 3, 4), dt.date(1900, 2, 27), None), ("hour + INTERVAL '20' HOUR", "time(6)", dt.time(2, 7, 8), dt.time(19, 59, 59), None), ("at + INTERVAL '2 12:00:00' DAY TO SECOND", "timestamp_ntz", dt.datetime(2011, 3, 8, 2, 25, 36, 125000), dt.datetime(1970, 1, 3, 11, 59, 59, 999999), None),
    ("at - INTERVAL '0-11' YEAR TO MONTH", "timestamp_ntz", dt.datetime(2010, 4, 5, 14, 25, 36, 125000), dt.datetime(1969, 1, 31, 23, 59, 59, 999999), None), ("TIMESTAMPADD(DAY, 3, at)", "timestamp_ntz", dt.datetime(2011, 3, 8, 14, 25, 36, 125000), dt.datetime(1970, 1, 3, 23, 59, 59, 999000), None), ("TIMESTAMPDIFF(DAY, TO_TIMESTAMP('2011-03-01 15:00:00'), at)", "int", 3, -15034, None), ("TIMESTAMPDIFF(MONTH, TO_TIMESTAMP('2010-12-31 00:00:00'), at)", "int", 3, -492, None),
    ("DATE_FORMAT_TZ(at, 'HH:mm', 'Asia/Kolkata')", "string", "14:25", "23:59", None), ("DATE_FORMAT_TZ(TO_TIMESTAMP_LTZ(l, 0), 'HH:mm', 'Asia/Kolkata')", "string", "05:45", "05:14", None), ("CAST(TO_TIMESTAMP_LTZ(l) AS STRING)", "string", "1970-01-01T00:00:00.9", "1969-12-31T23:59:59.099", None),
]

ZONED = [
    ("Asia/Kolkata", "DATE_FORMAT(TO_TIMESTAMP_LTZ(l, 0), 'HH:mm')", "05:45", "05:14", None), ("Asia/Kolkata", "DATE_FORMAT(at, 'HH:mm')", "14:25", "23:59", None), ("Asia/Kolkata", "EXTRACT(HOUR FROM TO_TIMESTAMP_LTZ(l, 0))", 5, 5, None),
    ("America/Bogota", "EXTRACT(YEAR FROM TO_TIMESTAMP_LTZ('2022-01-01 04:59:00.000'))", 2021, 2021, 2021), ("America/Bogota", "TO_DATE(at)", dt.date(2011, 3, 5), dt.date(1969, 12, 31), None),
]


@pytest.fixture(scope="module")
def records(spark):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    yield spark.sql(records_sql())
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def unlike(got, want):
    return not (abs(got - want) < 1e-6 * max(1, abs(want)) if isinstance(want, float) and got is not None else got == want)


def test_three_records(records):
    compiler = Compiler(records.sparkSession, records.schema)
    columns = [compiler.compile(text) for text, *_ in CASES]
    small = ("tinyint", "smallint", "int")  # an expression of small integers may stay small
    kinds = [(case[0], case[1], compiler.type_of(c).simpleString()) for case, c in zip(CASES, columns, strict=True)]
    assert not [k for k in kinds if k[1] != k[2] and not (k[1] in small and k[2] in small)]
    rows = {r["k"]: r for r in records.select("k", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()}
    assert not [(case[0], k, case[2 + j], rows[k][f"c{i}"]) for i, case in enumerate(CASES) for j, k in enumerate((1, -5, 0)) if unlike(rows[k][f"c{i}"], case[2 + j])]


@pytest.mark.parametrize("zone", sorted({z for z, *_ in ZONED}))
def test_zones(records, zone):
    spark = records.sparkSession
    spark.conf.set("spark.sql.session.timeZone", zone)
    frame, own = spark.sql(records_sql()), [c for c in ZONED if c[0] == zone]
    compiler = Compiler(spark, frame.schema)
    rows = {r["k"]: r for r in frame.select("k", *[compiler.compile(c[1]).alias(f"c{i}") for i, c in enumerate(own)]).collect()}
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert not [(c[1], k, c[2 + j], rows[k][f"c{i}"]) for i, c in enumerate(own) for j, k in enumerate((1, -5, 0)) if unlike(rows[k][f"c{i}"], c[2 + j])]


@pytest.mark.parametrize("text", ["CAST('half past two' AS TIMESTAMP(6))", "TO_TIMESTAMP('05.03.2011', 'yyyyMMdd')", "PARSE_JSON('{]')", "PARSE_JSON('{\"a\": 1, \"a\": 2}')", "SUBSTRING(word FROM 2 FOR -2)"])
def test_failures_at_run_time(records, text):
    compiler = Compiler(records.sparkSession, records.schema)
    with pytest.raises(Exception):  # noqa: B017
        records.select(compiler.compile(text)).collect()
