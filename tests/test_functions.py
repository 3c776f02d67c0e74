import json

import pytest
from pyspark.sql import functions as F

from auditflow.functions.json import as_written, merge_objects, without_keys
from auditflow.functions.text import split_codes, tab_line
from auditflow.functions.times import format_time, parse_time_ms

JAN_1_2018 = 1_514_764_800_000


def clock(hours, minutes, seconds):
    return (hours * 3600 + minutes * 60 + seconds) * 1000


# text, strict reading, lenient reading
TIMES = [
    ("2018-01-01 11:11:11", JAN_1_2018 + clock(11, 11, 11), JAN_1_2018 + clock(11, 11, 11)),
    ("2018-01-01 11:11:11xyz", None, JAN_1_2018 + clock(11, 11, 11)),
    ("2018-1-1 1:1:1", None, JAN_1_2018 + clock(1, 1, 1)),
    (" 2018-01-01  11:11:11", None, JAN_1_2018 + clock(11, 11, 11)),
    ("2018-01-01 24:00:00", None, JAN_1_2018 + clock(24, 0, 0)),
    # Month 13 is January 2019, day 45 is 14 February, 25:61:61 is 02:02:01 the next day.
    ("2018-13-45 25:61:61", None, 1_550_196_121_000),
    ("2018-00-01 00:00:00", None, 1_512_086_400_000),
    ("1970-01-01 00:00:00", 0, 0),
    # Signed fields: month -1 is November of the year before, hour -1 the last of the day before.
    ("2019--1-01 00:00:00", None, JAN_1_2018 + (365 - 61) * 86_400_000),
    ("2018-01-01 -1:-60: -30", None, JAN_1_2018 - clock(2, 0, 30)),
    ("-0001-01-01 00:00:00", -62_198_755_200_000, -62_198_755_200_000),
    ("12018-01-01 00:00:00", None, JAN_1_2018 + 25 * 146_097 * 86_400_000),
    # Fields of any length, also where one makes up for another.
    ("2018-01-" + "0" * 60 + "1 00:00:00", None, JAN_1_2018),
    ("0-24217-1 0:0:0", None, JAN_1_2018),
    ("2018-01-01 -9999999999999999:599999999999999940:0", None, JAN_1_2018),
    ("4018-01-01 00:00:00", JAN_1_2018 + 5 * 146_097 * 86_400_000, JAN_1_2018 + 5 * 146_097 * 86_400_000),
    # More than a timestamp holds.
    ("300000-01-01 00:00:00", None, None),
    ("-300000-01-01 00:00:00", None, None),
    ("2018-01-01 00:00:" + "9" * 30, None, None),
    ("2018-01-01T11:11:11", None, None),
    ("2018-01-01", None, None),
    ("bad", None, None),
    ("", None, None),
    (None, None, None),
]


def test_time_parsing(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in TIMES], "dt string")
    got = df.select("dt", parse_time_ms(F.col("dt"), lenient=False),
                    parse_time_ms(F.col("dt"), lenient=True)).collect()
    assert [tuple(r) for r in got] == TIMES


def test_time_formatting(spark):
    df = spark.createDataFrame([(JAN_1_2018 + 61_999,)], "ms bigint")
    assert df.select(format_time(F.col("ms"))).first()[0] == "2018-01-01 00:01:01"


def test_years_of_more_digits_are_written_without_a_sign(spark):
    df = spark.createDataFrame([(JAN_1_2018 + 25 * 146_097 * 86_400_000,)], "ms bigint")
    assert df.select(format_time(F.col("ms"))).first()[0] == "12018-01-01 00:00:00"
    assert df.select(format_time(F.col("ms"), "UTC")).first()[0] == "12018-01-01 00:00:00"


@pytest.mark.parametrize(
    "codes, expected",
    [
        ("PK,KW,SA", ["PK", "KW", "SA"]),
        ("PK,KW,SA,", ["PK", "KW", "SA"]),
        ("PK,,,", ["PK"]),
        ("US,,TW", ["US", "", "TW"]),
        (",US", ["", "US"]),
        ("TW, HK", ["TW", " HK"]),
        ("", [""]),
        (",", []),
        (",,", []),
    ],
)
def test_split_codes(spark, codes, expected):
    df = spark.createDataFrame([(codes,)], "codes string")
    assert df.select(split_codes(F.col("codes"))).first()[0] == expected


def test_tab_line_prints_null(spark):
    df = spark.createDataFrame([(5, None, "X")], "ms bigint, type string, area string")
    line = df.select(tab_line(F.col("ms"), F.col("type"), F.col("area"))).first()[0]
    assert line == "5\tnull\tX"


@pytest.mark.parametrize(
    "left, right",
    [("{}", "{}"), ('{"a":1}', "{}"), ("{}", '{"b":{"c":{}}}'), ('{"a":"}"}', '{"b":["{"]}')],
)
def test_merge_objects(spark, left, right):
    df = spark.createDataFrame([(left, right)], "l string, r string")
    merged = df.select(merge_objects(F.col("l"), F.col("r"))).first()[0]
    assert json.loads(merged) == {**json.loads(left), **json.loads(right)}


def test_without_keys(spark):
    df = spark.createDataFrame([('{"a":1,"b":null,"c":{"a":2}}',), ("[1]",)], "v string")
    item = F.parse_json("v")
    got = [r[0] for r in df.select(F.to_json(without_keys(item, "a"))).collect()]
    assert got == ['{"c":{"a":2}}', None]


def test_marked_literals_come_out_as_written(spark):
    m = "\ue000"
    expected = {
        f'{{"a":"{m}1.50","b":["{m}null","{m}2"]}}': '{"a":1.50,"b":[null,2]}',
        f'{{"a":"say \\"{m}1\\"","b":"{m}2"}}': f'{{"a":"say \\"{m}1\\"","b":2}}',
        f'{{"a":"{m}{m}x","b":"{m}2"}}': f'{{"a":"{m}x","b":2}}',
        f'{{"{m}5":"{m}1"}}': f'{{"{m}5":1}}',
        f'"{m}1"': "1", f'"{m}{m}1"': f'"{m}1"', '{"a":1}': '{"a":1}',
    }
    df = spark.createDataFrame([(t,) for t in expected], "t string")
    assert {r.t: r.o for r in df.select("t", as_written(F.col("t")).alias("o")).collect()} == expected
