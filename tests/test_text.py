"""Clean-up, intervals, lists and types: input and expected output pairs."""

import pytest
from pyspark.sql import functions as F

from scriptloom.functions import text, values


def outcome(spark, column, cases):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, x string")
    return [r[0] for r in df.coalesce(1).orderBy("i").select(column(F.col("x"))).collect()]


def test_dedent(spark):
    cases = {
        "\n      SELECT\n        a,\n        b\n      FROM t\n": "\nSELECT\n  a,\n  b\nFROM t\n",
        "SELECT\n  a\nFROM t": "SELECT\n  a\nFROM t",
        "\tSELECT\n\t\ta\n\tFROM t": "SELECT\n\ta\nFROM t",
        "  a\n\tb": "  a\n\tb",
        " \ta\n \t b": "a\n b",
        # A blank line does not count, and keeps what it has unless it starts with the indent.
        "  a\n \n   \n  b\r\n  ": "a\n \n \nb\r\n",
        "": "",
        "   \n ": "   \n ",
    }
    assert outcome(spark, text.dedent, cases) == list(cases.values())


def test_trim_edges(spark):
    cases = {
        "\n  \n  SELECT 1\n  FROM t\n\n  \n": "SELECT 1\n  FROM t",
        "  \x0bx　\x85": "x",
        "  \n ": "",
    }
    assert outcome(spark, text.trim_edges, cases) == list(cases.values())


def test_strip_comments(spark):
    cases = {
        "SELECT 1 -- trailing\n/* block */\n, 'keep -- in' AS s": (
            "SELECT 1 \n\n, 'keep -- in' AS s"
        ),
        "\"keep /* too */\" '''a--'b''' `c--d`--e": "\"keep /* too */\" '''a--'b''' `c--d`",
        "'it\\'s -- in' -- out": "'it\\'s -- in' ",
        "a 'open -- in": "a 'open -- in",
        # Of an open block comment the last character stays.
        "a /* open": "a n",
        "a /*": "a ",
    }
    assert outcome(spark, text.strip_comments, cases) == list(cases.values())


def test_clean_body_order_and_flags(spark):
    body = "\n  SELECT\n    a -- c\n  FROM t\n"

    def clean(**flags):
        return outcome(spark, lambda c: text.clean_body(c, **flags), [body])[0]

    assert clean() == "SELECT\n  a -- c\nFROM t"
    assert clean(trim_comments=True) == "SELECT\n  a \nFROM t"
    assert clean(trim_indentation=False) == "SELECT\n    a -- c\n  FROM t"
    assert clean(trim_body=False, trim_indentation=False) == body


def test_fill_project(spark):
    def fill(project):
        return lambda c: text.fill_project(c, F.lit(project))

    assert outcome(spark, fill("p"), ["`${project}`.d '${project}'"]) == ["`p`.d 'p'"]
    for nothing in ("", None):
        assert outcome(spark, fill(nothing), ["`${project}`.d"]) == ["`${project}`.d"]


def test_intervals(spark):
    cases = {
        "INTERVAL 90 MINUTE": "0-0 0 1:30:0",
        "INTERVAL 10 MINUTE": "0-0 0 0:10:0",
        "INTERVAL 4 HOUR": "0-0 0 4:0:0",
        'INTERVAL "4:0:0" HOUR TO SECOND': "0-0 0 4:0:0",
        "0-0 0 1:30:0": "0-0 0 1:30:0",
        "INTERVAL 2 DAY": "0-0 2 0:0:0",
        "INTERVAL 3600 SECOND": "0-0 0 1:0:0",
        "INTERVAL 1 YEAR": "1-0 0 0:0:0",
        "INTERVAL 3 MONTH": "0-3 0 0:0:0",
        "  interval 90 minute  ": "0-0 0 1:30:0",
        "INTERVAL '4:0:0' HOUR TO SECOND": "0-0 0 4:0:0",
        "not an interval": "not an interval",
        "INTERVAL '4' HOUR TO SECOND": "0-0 0 4:0:0",
        "INTERVAL '1:2:3:4' HOUR TO SECOND": "INTERVAL '1:2:3:4' HOUR TO SECOND",
        "INTERVAL 99999999999999999999 DAY": "INTERVAL 99999999999999999999 DAY",
    }
    assert outcome(spark, values.normalize_interval, cases) == list(cases.values())


def test_refresh_minutes_and_truth(spark):
    cases = {"60": 3600000, "0.5": 30000, "1e1": 600000, "soon": None, "1d": None}
    assert outcome(spark, values.minutes_to_millis, cases) == list(cases.values())
    flags = {"true": True, "TRUE": True, "yes": False, "false": False, None: None}
    assert outcome(spark, values.truth, flags) == list(flags.values())


def test_types(spark):
    cases = {
        "integer": "INT64",
        "NUMERIC(10, 2)": "NUMERIC",
        "ARRAY<STRUCT<a BIGINT, date DATE, c ARRAY< byteint >>>": (
            "ARRAY<STRUCT<a INT64, date DATE, c ARRAY<INT64>>>"
        ),
        "TABLE<id INT, n dec>": "TABLE<id INT64, n NUMERIC>",
        "bigdecimal": "BIGNUMERIC",
        "geography": "GEOGRAPHY",
        "": None,
    }
    assert outcome(spark, values.normalize_type, cases) == list(cases.values())


def test_lists_and_pairs(spark):
    lists = {
        "['a', \"b, c\" , d]": ["a", "b, c", "d"],
        "one": ["one"],
        "[]": [],
        "": [],
        None: None,
    }
    assert outcome(spark, values.string_list, lists) == list(lists.values())
    pairs = {
        '[("a", "1"), (\'b\',"2"), ("a","3")]': {"b": "2", "a": "3"},
        "[]": {},
        None: None,
    }
    assert outcome(spark, values.pair_map, pairs) == list(pairs.values())


@pytest.mark.parametrize("size", [200_000])
def test_long_texts_do_not_overflow(spark, size):
    """One pass and no recursion, whatever the length."""
    body = "'" + "a\\'" * size + "' -- x\n" + "/* c */ " * size
    df = spark.createDataFrame([(body,)], "x string")
    got = df.select(text.strip_comments(F.col("x")).alias("s")).collect()[0]["s"]
    assert got.strip() == "'" + "a\\'" * size + "'"
