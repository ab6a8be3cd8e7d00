"""References and rewriting: fixed cases, and a plain scanner over random bodies."""

import random
import re

import pytest
from pyspark.sql import functions as F

from scriptloom.functions import references as refs
from scriptloom.operators import references as ops
from scriptloom.operators.catalog import catalog

SCHEMA = "script_id string, body string, dataset_id string, object_id string"

# body, home dataset, home object -> sorted references, foreign datasets
CASES = {
    "call": (
        "SELECT t.category, ds5.array_distinct(ARRAY_AGG(t.items)) FROM tab AS t", "ds1", None,
        ["ds5.array_distinct SCALAR_FUNCTION ROUTINE"], ["ds5"]),
    "joins": (
        "SELECT * FROM ds4.vehicle AS v\nJOIN ds7.customer AS c ON v.id = c.id\n"
        "LEFT JOIN ds6.driver d ON true LEFT JOIN ds7.target t ON true", "ds1", None,
        ["ds4.vehicle VIEW VIEW", "ds6.driver VIEW VIEW", "ds7.customer VIEW VIEW",
         "ds7.target VIEW VIEW"], ["ds4", "ds6", "ds7"]),
    "three_parts": ("SELECT * FROM other.ds4.vehicle", "ds1", None, ["ds4.vehicle VIEW VIEW"],
                    ["ds4"]),
    "home": ("SELECT * FROM ds1.a e JOIN DS1.b o ON e.id = o.id", "ds1", None,
             ["DS1.b VIEW VIEW", "ds1.a VIEW VIEW"], []),
    "procedure": (
        "BEGIN\n  DECLARE e STRING DEFAULT ds5.env(@@project_id);\n  CALL ds2.proc(arg1);\n"
        "  INSERT INTO ds2.t3 VALUES (1);\n  UPDATE ds2.t4 SET f = 5;\n"
        "  DELETE FROM ds3.t4 WHERE f = 6;\n  TRUNCATE TABLE ds3.t5;\n"
        "  MERGE INTO ds2.t5 AS x USING ds3.t6 AS y ON x.id = y.id\n"
        "  WHEN MATCHED THEN UPDATE SET x = 1;\nEND", "ds1", None,
        ["ds2.proc PROCEDURE ROUTINE", "ds2.t3 VIEW VIEW", "ds2.t4 VIEW VIEW", "ds2.t5 VIEW VIEW",
         "ds3.t4 VIEW VIEW", "ds3.t5 VIEW VIEW", "ds3.t6 VIEW VIEW",
         "ds5.env SCALAR_FUNCTION ROUTINE"], ["ds2", "ds3", "ds5"]),
    "backticks": ("SELECT * FROM `ds7.driver` JOIN `ds4`.`vehicle` d ON true", "ds1", None,
                  ["ds4.vehicle VIEW VIEW", "ds7.driver VIEW VIEW"], ["ds4", "ds7"]),
    "cte": ("WITH tab AS (SELECT 1 AS id)\nSELECT * FROM tab, UNNEST([1,2]) AS n\n"
            "CROSS JOIN ds5.lookup l", "ds1", None, ["ds5.lookup VIEW VIEW"], ["ds5"]),
    "table_function": ("SELECT * FROM ds4.tvf(3)", "ds1", None,
                       ["ds4.tvf TABLE_VALUED_FUNCTION ROUTINE"], ["ds4"]),
    "metadata": ("SELECT x FROM `ds2`.INFORMATION_SCHEMA.TABLES AS t", "ds1", None,
                 ["ds2.INFORMATION_SCHEMA.TABLES TABLE VIEW"], ["ds2"]),
    "metadata_with_project": ("SELECT x FROM p.ds2.INFORMATION_SCHEMA.TABLES", "ds1", None,
                              ["ds2.INFORMATION_SCHEMA.TABLES TABLE VIEW"], ["ds2"]),
    "extract": ("SELECT EXTRACT(DAY FROM t1.c1), EXTRACT(DATE FROM TIMESTAMP(t1.c1))\n"
                "FROM ds2.t1 WHERE EXTRACT(DAY FROM t1.c1) BETWEEN 1 AND 7", "ds1", None,
                ["ds2.t1 VIEW VIEW"], ["ds2"]),
    "self": ("SELECT ds1.helper(1), ds1.own(2), ds1.OWN(3)", "ds1", "own",
             ["ds1.OWN SCALAR_FUNCTION ROUTINE", "ds1.helper SCALAR_FUNCTION ROUTINE"], []),
    "repeats": ("SELECT ds2.fn(1), ds2.fn(2) FROM ds1.t, ds2.fn", "other", "x",
                ["ds1.t VIEW VIEW", "ds2.fn SCALAR_FUNCTION ROUTINE"], ["ds1", "ds2"]),
    "no_home": ("SELECT * FROM ds1.t", None, None, ["ds1.t VIEW VIEW"], ["ds1"]),
    # Odd but kept.
    "insert_columns": ("INSERT INTO d.t(c) SELECT 1", None, None,
                       ["d.t SCALAR_FUNCTION ROUTINE"], ["d"]),
    "array_join": ("SELECT 1 FROM d.t AS a, a.items", None, None,
                   ["a.items VIEW VIEW", "d.t VIEW VIEW"], ["a", "d"]),
    "loose_comma": ("SELECT 1 FROM d.t AS a , d.u", None, None, ["d.t VIEW VIEW"], ["d"]),
    "no_alias_comma": ("SELECT 1 FROM d.t , d.u", None, None,
                       ["d.t VIEW VIEW", "d.u VIEW VIEW"], ["d"]),
    "spaced_call": ("SELECT d.f (1), d.g(1)", None, None, ["d.g SCALAR_FUNCTION ROUTINE"], ["d"]),
    "extract_subquery": ("SELECT EXTRACT(DAY FROM (SELECT x FROM d.t)) FROM d.u", None, None,
                         ["d.u VIEW VIEW"], ["d"]),
    "joined_metadata": ("SELECT 1 FROM `ds.INFORMATION_SCHEMA.X`", None, None,
                        ["INFORMATION_SCHEMA.X VIEW VIEW"], ["INFORMATION_SCHEMA"]),
    "text": ("SELECT 'FROM d.x', \"\"\"d.y(\"\"\" /* FROM d.z */ -- d.w(\nFROM d.t", None, None,
             ["d.t VIEW VIEW"], ["d"]),
    "long_name": ("SELECT a.b.c.d(1) FROM e.f.g.h", None, None,
                  ["c.d SCALAR_FUNCTION ROUTINE"], ["c"]),
    "spread_name": ("SELECT 1 FROM `d` . -- the dataset\n /* and */ t", None, None,
                    ["d.t VIEW VIEW"], ["d"]),
    "called_after_alias": ("SELECT 1 FROM d.t x.y.z(1), JOIN x.y(1)", None, None,
                           ["d.t VIEW VIEW", "x.y TABLE_VALUED_FUNCTION ROUTINE",
                            "y.z SCALAR_FUNCTION ROUTINE"], ["d", "x", "y"]),
    "letters": ("SELECT 1 FROM `dé`.`tü-1`", None, None, ["dé.tü-1 VIEW VIEW"], ["dé"]),
}


def test_fixed_cases(spark):
    df = spark.createDataFrame(
        [(k, body, home, obj) for k, (body, home, obj, _, _) in CASES.items()], SCHEMA)
    got = {
        r["script_id"]: ([" ".join((f"{x[0]}.{x[1]}", x[2], x[3])) for x in r["references"]],
                         list(r["dataset_references"]))
        for r in ops.with_references(df).collect()
    }
    assert got == {k: (references, sets) for k, (_, _, _, references, sets) in CASES.items()}


# --- a plain scanner ---------------------------------------------------------------------------

PIECES = [
    "FROM", "join", "INTO", "UPDATE", "CALL", "USING", "WHERE", "ON", "SELECT", "AS", "EXTRACT",
    "UNNEST", "WITH", "LEFT", "SET", "TABLE", "a.b", "c.d.e", "`f.g`", "`h`.`i`", "j", "k", "`l`",
    "m.n(", "o . p", "q.*", "r-s.t", ",", ", ", " ,", "(", ")", ";", "=", "1", "'x.y('", "--z.z(\n",
    "/* FROM w.w */", "u.v.w.x", "\n", "EXTRACT(", "EXTRACT (", ".",
]


def random_body(rng: random.Random) -> str:
    out = []
    for _ in range(rng.randint(1, 25)):
        out.append(rng.choice(PIECES))
        out.append(rng.choice(["", " ", " ", " "]))
    return "".join(out)


# Statements and whether each refers to its name (for metadata: the part before the object).
STATEMENTS = [
    ("SELECT 1 FROM {d}.{o};", True),
    ("SELECT 1 FROM x JOIN `{d}`.`{o}` AS k ON true;", True),
    ("CALL {d}.{o}(1);", True),
    ("SELECT {d}.{o}(2, 'q.w(') AS y;", True),
    ("INSERT INTO {d}.{o} (c) SELECT 1;", True),
    ("SELECT '{d}.{o}(' AS s;", False),
    ("-- FROM {d}.{o}\nSELECT 1;", False),
    ("/* CALL {d}.{o}() */ SELECT 1;", False),
    ("SELECT {d}.{o} + 1;", False),
    ("SELECT EXTRACT(DAY FROM {d}.{o});", False),
    ("SELECT 1 FROM {d}.INFORMATION_SCHEMA.{o};", "INFORMATION_SCHEMA."),
]


def test_names_of_random_statements(spark):
    rng = random.Random(7)
    bodies, expected = [], set()
    for i in range(400):
        parts = []
        for k in range(rng.randint(1, 12)):
            pattern, counts = rng.choice(STATEMENTS)
            parts.append(pattern.format(d=f"d{k}", o=f"o{i}"))
            if counts:
                schema = counts if isinstance(counts, str) else ""
                expected.add((str(i), f"d{k}", f"{schema}o{i}"))
        bodies.append((str(i), "\n".join(parts), None, None))
    df = spark.createDataFrame(bodies, SCHEMA).repartition(4)
    rows = ops.refs_table(ops.with_references(df)).collect()
    assert {(r["script_id"], r["dataset_id"], r["object_id"]) for r in rows} == expected


def test_pieces_tile_the_body(spark):
    rng = random.Random(11)
    bodies = [random_body(rng) for _ in range(500)] + ["", " ", "`", "'", "/*", "--", "a."]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    joined = df.select("body", F.array_join(refs.name_pieces(F.col("body")), "").alias("again"))
    assert joined.filter("body != again").count() == 0


IDLE = ("idle", "of", "heat", "x_1", "from1", "selects", "on-line", "-- note d.e\n", "/* f.g( */")


def test_runs_of_idle_words_change_no_name(spark):
    """Names found in single tokens and in tokens with runs of idle words taken together."""
    rng = random.Random(12)
    bodies = []
    for _ in range(400):
        pieces = [random_body(rng)]
        for _ in range(rng.randint(1, 8)):
            words = rng.choices(IDLE, k=rng.randint(1, 9))
            more = rng.choice(("FROM", "from a.b", "JOIN a.b AS", ", a.b c", "EXTRACT(", "a.b(", "INTO", ".", "(", ")", "Ü", "CALL"))
            pieces.insert(rng.randint(0, len(pieces)), " ".join([*words, more]))
        bodies.append(" ".join(pieces))
    df = spark.createDataFrame([(b,) for b in bodies], "body string").repartition(4)
    found = df.select(
        *[refs.kept_names(tokens(F.col("body"))).alias(tokens.__name__) for tokens in (refs.body_tokens, refs.name_tokens)]
    )
    same = [F.transform(c, lambda n: F.struct(n["token"], n["role"], n["joined"])) for c in found.columns]
    assert found.filter(F.size("body_tokens") > 2).count() > 100
    assert found.filter(same[0] != same[1]).count() == 0


def test_many_names_in_one_body(spark):
    """More names than the fold's short list holds."""
    body = "SELECT " + ", ".join(f"d{i % 9}.f{i}(1)" for i in range(2000))
    df = spark.createDataFrame([("s", body, None, None)], SCHEMA)
    assert ops.refs_table(ops.with_references(df)).count() == 2000
    named = ops.body_names(df).collect()
    assert [r["object_id"] for r in named] == [f"f{i}" for i in range(2000)]


# --- rewriting ---------------------------------------------------------------------------------

REWRITES = {
    "call": ("CREATE TABLE FUNCTION ds1.f(n INT64) AS (\n  SELECT ds2.fn([1, 1]) AS u\n);", "p-1",
             "SELECT `p-1`.`ds2`.`fn`([1, 1]) AS u"),
    "own_project": ("CREATE FUNCTION `myproj.ds1.fn`(x INT64) RETURNS INT64 AS (ds2.add_one(x));",
                    None, "`myproj`.`ds2`.`add_one`(x)"),
    "empty_turns_off": ("CREATE FUNCTION `myproj.ds1.fn`(x INT64) AS (ds2.add_one(x));", "",
                        "ds2.add_one(x)"),
    "no_project": ("CREATE FUNCTION ds1.fn(x INT64) AS (ds2.add_one(x));", None,
                   "ds2.add_one(x)"),
    "view_kept": ("CREATE VIEW ds1.v AS SELECT 1 FROM ds2.t", "p", "SELECT 1 FROM ds2.t"),
    "three_parts": ("CREATE FUNCTION ds1.f() AS (o.ds2.g(1) + Ds1.h(1) + ds2 . i(1));", "p",
                    "o.ds2.g(1) + Ds1.h(1) + `p`.`ds2`.`i`(1)"),
    "metadata": ("CREATE FUNCTION ds1.f() AS (\n(SELECT x FROM `ds2`.INFORMATION_SCHEMA.TABLES)\n"
                 ");", "p", "(SELECT x FROM `p`.`ds2`.INFORMATION_SCHEMA.TABLES)"),
    "placeholder": ("CREATE FUNCTION ds1.f() AS (\n(SELECT '${project}' FROM `${project}`.`ds2`.`t`"
                    " JOIN `ds3.u` v ON v.x.* IS NULL)\n);", "p",
                    "(SELECT 'p' FROM `p`.`ds2`.`t` JOIN `p`.`ds3`.`u` v ON v.x.* IS NULL)"),
    "nothing_found": ("CREATE FUNCTION ds1.f() AS (1);", "p", "1"),
}


@pytest.mark.parametrize("project", [None, "p", "p-1", ""])
def test_rewriting(make_scripts, project):
    cases = {k: v for k, v in REWRITES.items() if v[1] == project}
    scripts = make_scripts({k: sql for k, (sql, _, _) in cases.items()})
    got = {r["script_id"]: r["body"] for r in ops.qualify(catalog(scripts), project).collect()}
    assert got == {k: body for k, (_, _, body) in cases.items()}


QUIET = (
    "SELECT", "a.b", "`c.d`", "`e`", "x", ",", " ,", "'FROM f.g('", "max(z)", "count(DISTINCT a.b, 1)", "= 1", "AS", "h.INFORMATION_SCHEMA.i",
    ";", "ORDER BY", "k .", "-- FROM l.m(\n", "/* ) */", "(", ")", "()", "f(", "n.o.p.q.r", "ON", "WITH", "UNNEST",
)
LOUD = (
    "FROM s.t", "FROM s.t AS where, u.v", "JOIN s.t with, u.v", "FROM s.t unnest x, u.v", "s.t(1)", "EXTRACT(DAY FROM s.t)", "CALL s.t",
    "FROM s.t AS on\n, u.v", "FROM s.t x s.w.y(", "`s.t`(", "INTO s.t", "USING s.t", "EXTRACT WHERE (", "FROM", "update", "FROM s.t AS `a(`, u.v",
)


def test_stretches_without_names_change_no_name(spark):
    """Behind parens, semicolons and closing words, what holds no name is passed over."""
    rng = random.Random(13)
    bodies = [
        rng.choice(("", " ", "\n")).join(rng.choice(QUIET if rng.random() < 0.7 else LOUD) for _ in range(rng.randint(2, 25)))
        for _ in range(800)
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "body string").repartition(4)
    found = df.select(
        "body", *[refs.kept_names(tokens(F.col("body"))).alias(tokens.__name__) for tokens in (refs.body_tokens, refs.name_tokens)]
    )
    same = [F.transform(c, lambda n: F.struct(n["token"], n["role"], n["joined"])) for c in found.columns[1:]]
    assert found.filter(F.size("body_tokens") > 2).count() > 100
    assert found.filter(same[0] != same[1]).select("body").collect() == []
    again = df.select("body", F.array_join(refs.name_pieces(F.col("body")), "").alias("again"))
    assert again.filter("body != again").count() == 0


def test_few_tokens_are_left_of_a_plain_query(spark):
    body = "SELECT a.x, max(z), 'q' AS y FROM ds.v WHERE a.x = b.x AND c IN (1, 2) ORDER BY a.x; SELECT count(*) FROM ds.w"
    df = spark.createDataFrame([(body,)], "body string").select(refs.name_tokens(F.col("body")).alias("tokens"))
    assert [t for t in df.first()["tokens"] if t][:2] == ["FROM", "ds.v"]
    assert len([t for t in df.first()["tokens"] if t]) <= 6
