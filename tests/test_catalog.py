"""Headers, bodies, options and rejects."""

import json

import pytest
from pyspark.sql import functions as F

from scriptloom.functions import body as bodies
from scriptloom.functions import header as headers
from scriptloom.functions import values
from scriptloom.operators import catalog as cat
from scriptloom.operators import children

VIEW = """
    CREATE OR REPLACE VIEW IF NOT EXISTS `ds.simple`
    (
      A OPTIONS(description="The first, of two"),
      B OPTIONS(description='b'),
    ) OPTIONS(
      description="Simple view"
    ) AS
      SELECT A, B
      FROM ds.INFORMATION_SCHEMA.TABLES;"""
MATERIALIZED = """
    CREATE OR REPLACE MATERIALIZED VIEW IF NOT EXISTS `ds.mv`
    PARTITION BY DATE(CREATED)
    CLUSTER BY A, B
    OPTIONS(
      description="mv", enable_refresh=TRUE, allow_non_incremental_definition=FALSE,
      refresh_interval_minutes=60, max_staleness=INTERVAL "4:0:0" HOUR TO SECOND,
      retain_partitions=true, kms_key_name="projects/123/key",
      labels=[("org_unit", "development")]
    ) AS
      SELECT 1 AS A;"""
PYTHON = """CREATE FUNCTION `proj`.`ds`.multiply (x FLOAT64, y FLOAT64)
RETURNS FLOAT64
OPTIONS (max_batching_rows = 10, entry_point = 'multiply', runtime_version = "python-3.11")
LANGUAGE python
WITH CONNECTION proj.us.conn
AS r '''

def multiply(x, y):
    return x * y

''';
SELECT `proj.ds`.multiply(1, 2);
"""
REMOTE = """CREATE FUNCTION `proj.ds`.encrypt(x BYTES)
RETURNS BYTES
REMOTE WITH CONNECTION `proj.us-east4.conn`
OPTIONS (endpoint = 'https://e', user_defined_context = [("mode", "encryption")])
"""
SPARK_PROC = """CREATE PROCEDURE proj.ds.job(num INT64, info ARRAY<STRUCT<a INT64, b STRING>>)
WITH CONNECTION `p-id.us.conn`
OPTIONS(engine="SPARK", runtime_version="2.2", jar_uris=['gs://a.jar', "gs://b.jar"])
LANGUAGE PYTHON AS R\"\"\"
spark = 'x'
\"\"\"
"""
SPARK_BODYLESS = """CREATE PROCEDURE proj.ds.job2 ()
WITH
CONNECTION `p-id.us.conn`
OPTIONS (engine = "SPARK", main_file_uri = "gs://main.py")
LANGUAGE PYTHON"""
TABLE_FUNCTION = """CREATE OR REPLACE TABLE FUNCTION `ds.tf`
(
  min_id SMALLINT,   -- comment, with a comma and a (paren
  trips TABLE<
    plate STRING,
    at TIMESTAMP
  >
)
-- the returned table
RETURNS TABLE<id INT64, name STRING>
AS (
  SELECT id, COLLATE(name, ')') AS name -- :)
  FROM `ds.kind` AS e
  WHERE e.id >= min_id
);
"""
AGGREGATE = """CREATE AGGREGATE FUNCTION ds.agg(a FLOAT64, b FLOAT64 NOT AGGREGATE, c ANY TYPE, d)
RETURNS FLOAT64 AS (SUM(a) / b);"""
PROCEDURE = """CREATE OR REPLACE PROCEDURE ds.proc(name STRING, OUT id STRING, INOUT n INT)
OPTIONS (description = 'daily')
BEGIN
  DECLARE sep STRING DEFAULT CASE WHEN name = ';' THEN ',' ELSE '' END;
  DECLARE env STRING DEFAULT ds5.env(@@project_id);
  SET id = 'END'; /* END */ -- END
  IF name IS NULL THEN
    BEGIN
      SELECT IF(true, 1, REPEAT('a', 2)), `END`;
    END;
  END IF;
  WHILE FALSE DO SELECT 2; END WHILE;
  LOOP BREAK; END LOOP;
  FOR r IN (SELECT 1 AS x FROM ds.t FOR SYSTEM_TIME AS OF y) DO SELECT r.x; END FOR;
  REPEAT SELECT 3; UNTIL TRUE END REPEAT;
  SELECT 4;
END; SELECT 5
"""
SCRIPTS = {
    "view": VIEW,
    "mv": MATERIALIZED,
    "python": PYTHON,
    "remote": REMOTE,
    "spark": SPARK_PROC,
    "spark2": SPARK_BODYLESS,
    "tf": TABLE_FUNCTION,
    "agg": AGGREGATE,
    "proc": PROCEDURE,
    "escaped": "CREATE FUNCTION ds.f(x INT64) RETURNS INT64\n"
    "OPTIONS(description = 'first', Description='it\\'s a helper')\nAS (x);",
    "bare": "CREATE VIEW lonely AS SELECT 1 AS x",
    "full": "create view `p.ds.v` as\n  SELECT 1;",
    "union": "CREATE VIEW ds.u AS (SELECT 1) UNION ALL (SELECT ';'); SELECT 2",
    "paren": "CREATE VIEW ds.w AS (SELECT 1) -- end\n; SELECT 2",
    "not_agg": "CREATE FUNCTION ds.g(x INT64 NOT AGGREGATE) RETURNS INT64 AS (x);",
    "commented": "/* a */ -- b\nCREATE /* c */ FUNCTION ds . h() AS (\n 1\n);\n-- tail",
    "js": "CREATE FUNCTION parse(j STRING)\nRETURNS ARRAY<STRING>\nLANGUAGE js AS r\"\"\"\n"
    "  return [];\n\"\"\";",
    "part": "CREATE MATERIALIZED VIEW ds.p PARTITION BY TIMESTAMP_TRUNC(ts, HOUR) AS SELECT 1",
}


@pytest.fixture(scope="module")
def rows(make_scripts):
    return {r["script_id"]: r for r in cat.catalog(make_scripts(SCRIPTS)).collect()}


def test_all_accepted(rows):
    assert set(rows) == set(SCRIPTS)


def test_kinds(rows):
    kinds = {k: rows[k]["kind"] for k in ("view", "mv", "python", "spark", "tf", "agg")}
    assert kinds == {
        "view": "VIEW",
        "mv": "MATERIALIZED_VIEW",
        "python": "SCALAR_FUNCTION",
        "spark": "PROCEDURE",
        "tf": "TABLE_VALUED_FUNCTION",
        "agg": "AGGREGATE_FUNCTION",
    }


def test_names_and_ids(rows):
    def ids(key):
        r = rows[key]
        return [r[c] for c in ("project", "dataset_id", "object_id", "reference_id", "resource_id")]

    assert ids("view") == [
        None, "ds", "simple", "ds.simple", "projects/any/datasets/ds/tables/simple"]
    assert ids("python") == [
        "proj", "ds", "multiply", "ds.multiply", "projects/proj/datasets/ds/routines/multiply"]
    assert ids("bare") == [None, None, "lonely", None, "projects/any/datasets/any/tables/lonely"]
    assert ids("full") == ["p", "ds", "v", "ds.v", "projects/p/datasets/ds/tables/v"]
    assert ids("commented")[:3] == [None, "ds", "h"]


def test_view_settings(rows):
    r = rows["mv"]
    assert (r["partitioning_type"], r["partitioning_field"]) == ("DAY", "CREATED")
    assert rows["part"]["partitioning_field"] == "ts"
    assert r["clustering"] == ["A", "B"]
    assert r["enable_refresh"] is True and r["allow_non_incremental_definition"] is False
    assert r["refresh_interval_ms"] == 3_600_000
    assert r["max_staleness"] == "0-0 0 4:0:0"
    assert r["kms_key_name"] == "projects/123/key"
    assert r["labels"] == {"org_unit": "development"}
    assert rows["view"]["labels"] == {} and rows["view"]["enable_refresh"] is None
    assert [tuple(c) for c in rows["view"]["view_columns"]] == [
        ("A", "The first, of two"), ("B", "b")]


def test_bodies(rows):
    assert rows["view"]["body"] == "SELECT A, B\nFROM ds.INFORMATION_SCHEMA.TABLES"
    assert rows["python"]["body"] == "def multiply(x, y):\n    return x * y"
    assert rows["spark"]["body"] == "spark = 'x'"
    assert rows["remote"]["body"] == "" and rows["spark2"]["body"] == ""
    assert rows["tf"]["body"].endswith("WHERE e.id >= min_id")
    assert rows["union"]["body"] == "(SELECT 1) UNION ALL (SELECT ';')"
    assert rows["paren"]["body"] == "SELECT 1"
    assert rows["commented"]["body"] == "1"
    assert rows["js"]["body"] == "return [];"
    body = rows["proc"]["body"]
    assert body.startswith("BEGIN") and body.endswith("SELECT 4;\nEND")


def test_languages_and_return_types(rows):
    assert [rows[k]["language"] for k in ("js", "python", "tf", "view")] == [
        "JAVASCRIPT", "PYTHON", "SQL", None]
    assert rows["js"]["return_type"] == "ARRAY<STRING>"
    assert rows["tf"]["return_table_type"] == "TABLE<id INT64, name STRING>"
    assert rows["tf"]["return_type"] is None


def test_option_groups(rows):
    r = rows["python"]
    assert r["remote_function_options"] is None and r["spark_options"] is None
    assert r["python_options"]["entry_point"] == "multiply"
    external = r["external_runtime_options"]
    assert external["max_batching_rows"] == "10"
    assert external["runtime_version"] == "python-3.11"
    assert external["runtime_connection"] == "proj.us.conn"

    remote = rows["remote"]["remote_function_options"]
    assert remote["connection"] == "proj.us-east4.conn" and remote["endpoint"] == "https://e"
    assert remote["user_defined_context"] == {"mode": "encryption"}

    spark_options = rows["spark"]["spark_options"]
    assert spark_options["connection"] == "p-id.us.conn"
    assert spark_options["runtime_version"] == "2.2"
    assert spark_options["jar_uris"] == ["gs://a.jar", "gs://b.jar"]
    assert rows["spark"]["external_runtime_options"] is None
    assert rows["spark2"]["spark_options"]["main_file_uri"] == "gs://main.py"
    assert rows["tf"]["remote_function_options"] is None
    assert rows["escaped"]["description"] == "it's a helper"


def test_arguments(rows):
    def args(key):
        return [tuple(a)[:5] for a in rows[key]["arguments"]]

    assert args("tf") == [
        ("min_id", "INT64", "FIXED_TYPE", None, None),
        ("trips", "TABLE<plate STRING, at TIMESTAMP>", "FIXED_TYPE", None, None),
    ]
    assert args("agg") == [
        ("a", "FLOAT64", "FIXED_TYPE", None, True),
        ("b", "FLOAT64", "FIXED_TYPE", None, False),
        ("c", None, "ANY_TYPE", None, True),
        ("d", None, "FIXED_TYPE", None, True),
    ]
    assert args("proc") == [
        ("name", "STRING", "FIXED_TYPE", None, None),
        ("id", "STRING", "FIXED_TYPE", "OUT", None),
        ("n", "INT64", "FIXED_TYPE", "INOUT", None),
    ]
    assert args("not_agg") == [("x", "INT64", "FIXED_TYPE", None, False)]
    assert args("spark")[1][1] == "ARRAY<STRUCT<a INT64, b STRING>>"


def test_type_trees(rows):
    def kinds(*names):
        return [{"typeKind": n} for n in names]

    def columns(*pairs):
        return {"columns": [{"name": n, "type": {"typeKind": t}} for n, t in pairs]}

    trips = json.loads(rows["tf"]["arguments"][1]["data_type_json"])
    assert trips == {"typeKind": "TABLE", "tableType": columns(("plate", "STRING"), ("at", "TIMESTAMP"))}
    returned = json.loads(rows["tf"]["return_table_type_json"])
    assert returned == columns(("id", "INT64"), ("name", "STRING"))
    assert rows["tf"]["return_type_json"] is None
    assert json.loads(rows["js"]["return_type_json"]) == {
        "typeKind": "ARRAY", "arrayElementType": {"typeKind": "STRING"}}
    assert [json.loads(a["data_type_json"]) for a in rows["proc"]["arguments"]] == kinds(
        "STRING", "STRING", "INT64")
    assert [a["data_type_json"] for a in rows["agg"]["arguments"]][2:] == [None, None]
    assert json.loads(rows["view"]["schema_json"])[1] == {
        "name": "B", "type": "STRING", "mode": "NULLABLE", "description": "b"}
    assert rows["mv"]["schema_json"] is None


@pytest.mark.parametrize(
    "written, tree",
    [
        ("struct<>", {"typeKind": "STRUCT", "structType": {}}),
        ("array<>", {"typeKind": "ARRAY", "arrayElementType": {"typeKind": ""}}),
        ("TABLE<>", {"typeKind": "TABLE"}),
        ("range<date>", {"typeKind": "RANGE"}),
        ("numeric(10, 2)", {"typeKind": "NUMERIC"}),
        ('STRUCT<int, `a"b` RANGE<DATE>, q STRING NOT NULL,>', {
            "typeKind": "STRUCT", "structType": {"fields": [
                {"type": {"typeKind": "INT64"}},
                {"name": 'a"b', "type": {"typeKind": "RANGE"}},
                {"name": "q", "type": {"typeKind": "STRING"}}]}}),
    ],
)
def test_odd_type_trees(spark, written, tree):
    typed = spark.createDataFrame([(written,)], "t string").select(
        values.type_json(values.normalize_type(F.col("t"))))
    assert json.loads(typed.first()[0]) == tree


def test_child_tables(make_scripts):
    catalog = cat.catalog(make_scripts({"mv": MATERIALIZED, "spark": SPARK_PROC}))
    assert {tuple(r) for r in children.list_options(catalog).collect()} == {
        ("spark", "jar_uris", 1, "gs://a.jar"), ("spark", "jar_uris", 2, "gs://b.jar")}
    assert {tuple(r) for r in children.pair_options(catalog).collect()} == {
        ("mv", "labels", "org_unit", "development")}
    options = {r["name"]: r["value"] for r in children.options(catalog.filter("kind != 'PROCEDURE'"))
               .collect()}
    assert options["max_staleness"] == 'INTERVAL "4:0:0" HOUR TO SECOND'
    assert options["labels"] == '[("org_unit", "development")]'
    assert options["retain_partitions"] == "true"


BROKEN = {
    "empty": ("  \n ", "empty script"),
    "hash": ("CREATE FUNCTION #foo() AS (SELECT 1)", "bad character or open quote"),
    "open_name": ("CREATE VIEW `ds.v AS SELECT 1", "bad character or open quote"),
    "select": ("SELECT 1", "not a CREATE statement"),
    "table": ("CREATE TABLE ds.t (x INT64)", "unknown object kind"),
    "no_name": ("CREATE FUNCTION RETURNS INT64 AS (SELECT 1)", "no object name"),
    "open_options": (
        "CREATE PROCEDURE ds.p()\nOPTIONS (description = 'x'\nBEGIN\n  SELECT 1;\nEND;",
        "malformed header"),
    "no_begin": ("CREATE PROCEDURE ds.p()\nSELECT 1;", "malformed header"),
    "deterministic": ("CREATE FUNCTION ds.f() RETURNS INT64 DETERMINISTIC AS (1)",
                      "malformed header"),
    "bad_argument": ("CREATE FUNCTION ds.f(x INT64 y) AS (1)", "malformed header"),
    "view_begin": ("CREATE VIEW ds.v BEGIN SELECT 1; END", "no body"),
    "no_body": ("CREATE FUNCTION ds.f()", "no body"),
    "blank_body": ("CREATE VIEW ds.f AS  \n", "no body"),
    "open_paren": ("CREATE TABLE FUNCTION ds.p()\nAS (\n  SELECT 1\n", "unclosed body"),
    "open_raw": ("CREATE FUNCTION ds.p() AS r'''x''", "unclosed body"),
    "temp": ("CREATE TEMP FUNCTION foo(x INT64) AS (x+1);", "temporary object"),
    "temporary": ("create or replace temporary function foo() as (1)", "temporary object"),
} | {
    name: (f"CREATE PROCEDURE ds.p()\nBEGIN\n{body}\n", "unclosed body")
    for name, body in {
        "no_end": "SELECT 1;",
        "open_case": "DECLARE x STRING DEFAULT CASE WHEN 1 = 1 THEN 'a' ELSE 'b';\nEND;",
        "open_if": "IF 1 = 1 THEN\n SELECT 1;\nEND;",
        "open_while": "WHILE TRUE DO SELECT 1;\nEND;",
        "open_loop": "LOOP SELECT 1;\nEND;",
        "open_for": "FOR r IN (SELECT 1 AS x) DO SELECT r.x;\nEND;",
        "open_repeat": "REPEAT SELECT 1; UNTIL TRUE\nEND;",
        "open_inner": "BEGIN SELECT 1;\nEND;",
        "open_string": "SET msg = 'oops;\nEND;",
        "open_comment": "/* never closed\nSELECT 1;\nEND;",
        "orphan_end_if": "END IF;\nSELECT 1;",
    }.items()
}


def test_rejects(make_scripts):
    scripts = make_scripts({k: sql for k, (sql, _) in BROKEN.items()})
    got = {r["script_id"]: r["reason"] for r in cat.rejects(scripts).collect()}
    assert got == {k: reason for k, (_, reason) in BROKEN.items()}
    assert cat.catalog(scripts).count() == 0


def test_reject_places(make_scripts):
    lead = " \n\t"
    cases = {
        "hash": (lead + BROKEN["hash"][0], lead + "CREATE FUNCTION "),
        "select": (lead + "-- c\nSELECT 1", lead + "-- c\n"),
        "no_name": (BROKEN["no_name"][0], "CREATE FUNCTION"),
        "open_paren": (BROKEN["open_paren"][0], BROKEN["open_paren"][0].split("(\n")[0]),
        "open_body": ("CREATE VIEW d.v\nAS\n \t(SELECT (1)", "CREATE VIEW d.v\nAS\n \t"),
        "open_quote": ("CREATE FUNCTION d.f()\nLANGUAGE js AS  r\'\'\'x", "CREATE FUNCTION d.f()\nLANGUAGE js AS  "),
        "open_block": ("CREATE PROCEDURE d.p()\n  BEGIN\nSELECT 1;", "CREATE PROCEDURE d.p()\n  "),
        "open_args": ("CREATE FUNCTION d.f(\n x ARRAY<INT64> AS (1)", "CREATE FUNCTION d.f"),
        "open_options": ("CREATE VIEW d.v (a)\nOPTIONS (labels=[('a', 'b')\nAS SELECT 1", "CREATE VIEW d.v (a)\nOPTIONS "),
        "stray": ("CREATE VIEW d.v\n (a)) AS SELECT 1", "CREATE VIEW d.v\n (a)"),
        "no_body": ("CREATE VIEW d.v\n AS \n ", "CREATE VIEW d.v\n AS"),
        "empty": (" \n ", ""),
        "null": (None, ""),
    }
    got = {
        r["script_id"]: (r["offset"], r["line"], r["column"])
        for r in cat.rejects(make_scripts({k: sql for k, (sql, _) in cases.items()})).collect()
    }
    assert got == {
        k: (len(read), read.count("\n") + 1, len(read.split("\n")[-1]) + 1) for k, (_, read) in cases.items()
    }


def test_one_pass_has_both(make_scripts):
    scripts = make_scripts({"view": VIEW, "bad": BROKEN["hash"][0], "tf": TABLE_FUNCTION})
    checked = cat.checked_rows(scripts)
    accepted = checked.where("reason IS NULL").drop(*cat.REJECT_COLUMNS[1:])
    assert sorted(map(str, accepted.collect())) == sorted(map(str, cat.catalog(scripts).collect()))
    rejected = checked.where("reason IS NOT NULL").select(*cat.REJECT_COLUMNS)
    assert rejected.collect() == cat.rejects(scripts).collect()


def test_control_signs_in_option_texts(make_scripts):
    odd = "a\x01b\x02e\x02r\x03c"
    scripts = make_scripts({"v": f"CREATE VIEW d.v OPTIONS(description='{odd}', friendly_name='f') AS SELECT 1"})
    row = cat.catalog(scripts).first()
    assert (row["description"], row["friendly_name"]) == (odd, "f")


def test_wide_views_keep_all_columns_in_order(make_scripts):
    columns = ",\n".join(f'c{i} OPTIONS(description="the {i}, (col)")' for i in range(3000))
    row = cat.catalog(make_scripts({"v": f"CREATE VIEW d.v ({columns}) AS SELECT 1"})).first()
    assert [tuple(c) for c in row["view_columns"]] == [(f"c{i}", f"the {i}, (col)") for i in range(3000)]


def _outcomes(spark, found, folded, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").coalesce(1)
    return df.select("x", found(F.col("x")).alias("found"), folded(F.col("x")).alias("folded")).collect()


def test_headers_without_a_fold(spark):
    """Groups cut out by patterns are those of the fold; comments, odd leads and open brackets are folded."""
    texts = [
        "", " ", ";", "(a, b)", " (x INT64, y ARRAY<STRUCT<a INT, b NUMERIC(1, 2)>>, ) RETURNS  TABLE<a INT>;(z)",
        "(a OPTIONS(d=\"k, ) of\"), `b (`)\nOPTIONS (l=[('a', 'b'), (\"c\", 'd')], m = INTERVAL 1 DAY ,, n=1, )",
        "(a, -- b)\n c) OPTIONS /* d */ (e='f')", "RETURNS x = (a) LANGUAGE 'js' (b)", "()<>(a)", "(a))", "OPTIONS ((a)",
        "(" * 12 + "a" + ")" * 12, "OPTIONS(a='\x01\x02e\x03')", "'open (a)", "\u3000(a\u3000,\tb)\n\n X (c - d / e)",
    ]
    for row in _outcomes(spark, headers.outline, headers._folded_outline, texts):
        same = 3 if row["folded"]["depth"] == 0 else 4
        assert row["found"][:same] == row["folded"][:same], row["x"]


def test_bodies_without_a_fold(spark):
    parens = ["(a)", "((a) ')' \")\" `)` -- )\n /* ) */) x)", "((a)", "(" * 12 + ")" * 12, "(\"\"\")\"\"\" - 1 / 2)(b)", "('a)"]
    for row in _outcomes(spark, bodies.paren_length, bodies._folded_parens, parens):
        assert row["found"] == row["folded"], row["x"]
    blocks = [
        "BEGIN END", "begin IF a THEN BEGIN x; END; END IF; END; y END", "BEGIN CASE WHEN a THEN 1 END; END z END",
        "BEGIN CASE a BEGIN x; END; END CASE; END; END", "BEGIN IF a THEN x; END; END", "BEGIN END IF; END", "BEGIN x",
        "BEGIN LOOP IF(a, 'END', 1); END  loop; REPEAT x UNTIL y END REPEAT; END", "BEGIN END IFX", "BEGIN CASE CASE END END CASE END",
        "BEGIN " * 9 + "END " * 9 + "END", "BEGIN WHILE a DO BEGIN b; END; LOOP c; END; END WHILE; END; END",
    ]
    for row in _outcomes(spark, bodies.block_length, bodies._folded_block, blocks):
        assert row["found"] == row["folded"], row["x"]


def test_plain_headers_and_bodies_fit_the_patterns(spark):
    """Where the patterns stopped short, all work would fall back on the folds."""
    parts = {
        headers._TOP: ["(\n  A OPTIONS(description=\"The first, of two\"),\n) OPTIONS(\n  labels=[('a', 'b')]\n) ", "(a ARRAY<STRUCT<b INT64>>) RETURNS INT64"],
        bodies._PAREN_GROUP: ["((SELECT ')' AS a))"],
        bodies._BLOCK_GROUP: ["BEGIN IF a THEN LOOP BREAK; END LOOP; END IF; SET x = CASE WHEN a THEN 1 END; END"],
    }
    for pattern, texts in parts.items():
        df = spark.createDataFrame([(t,) for t in texts], "x string")
        assert [r[0] for r in df.select(F.regexp_extract("x", pattern, 0)).collect()] == texts


def test_families(make_scripts):
    scripts = make_scripts({"view": VIEW, "tf": TABLE_FUNCTION})
    assert [r["script_id"] for r in cat.catalog(scripts, cat.VIEW).collect()] == ["view"]
    assert [tuple(r)[:2] for r in cat.rejects(scripts, cat.VIEW).collect()] == [("tf", "not a view")]
    assert [tuple(r)[:2] for r in cat.rejects(scripts, cat.ROUTINE).collect()] == [
        ("view", "not a routine")]


def test_filters_on_the_catalog_stay_above_it(make_scripts):
    """A filter must not be written out into the projections it reads from."""
    catalog = cat.catalog(make_scripts({"view": VIEW, "tf": TABLE_FUNCTION}))
    kept = catalog.filter("description is not null and kind = 'VIEW'")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Filter")
    assert plan.count("Filter") == 1
    assert [r["script_id"] for r in kept.collect()] == ["view"]


def test_one_pass_computes_only_what_is_used(make_scripts):
    scripts = make_scripts({"f": "CREATE FUNCTION d.f(x INT64) RETURNS INT64 AS (x);"})

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    checked = cat.checked_rows(scripts)
    assert "typeKind" in plan(checked)
    assert "typeKind" not in plan(checked.select("script_id", "reason", "kind", "body"))
    assert checked.columns == [*cat.REJECT_COLUMNS, *cat.catalog_rows(scripts).columns[1:]]


def test_scripts_of_the_other_family_are_dropped_before_their_header_is_worked_on(spark):
    sqls = [
        None, "", "SELECT 1", "CREATE VIEW d.v AS SELECT 1", "CREATE VIEW d.v OPTIONS( AS SELECT 1", "CREATE TEMP FUNCTION d.f() AS (1)",
        "CREATE FUNCTION d.f(x INT64) AS (x)", "CREATE FUNCTION d.f(x INT64) AS (x", "CREATE TABLE d.t", "CREATE VIEW d.v 'open",
        "CREATE MATERIALIZED VIEW d.m CLUSTER BY a AS SELECT 1 a", "CREATE PROCEDURE d.p() BEGIN SELECT 1; END", "CREATE FUNCTION",
    ]
    scripts = spark.createDataFrame([(str(i), sql) for i, sql in enumerate(sqls)], "script_id string, sql string")
    for family, kept in ((cat.VIEW, {"3", "10"}), (cat.ROUTINE, {"6", "11"}), (None, {"3", "6", "10", "11"})):
        rows = cat.catalog_rows(scripts, family)
        assert {r["script_id"] for r in rows.select("script_id").collect()} == kept
        left_out = {r["script_id"] for r in cat.rejects(scripts, family).collect()}
        assert left_out == {str(i) for i in range(len(sqls))} - kept
        plan = rows.select("script_id", "arguments")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.rindex("Generate explode") > plan.rindex("AS _outlined")


def test_steps_of_the_outline_are_columns_worked_out_once(spark):
    clauses = ["", "()", "(a)(b)", "(a, (b)) OPTIONS(x=[1, 2])", "x\x01 OPTIONS(a=1)", " PARTITION BY f(c) ;(", "(a", "-- (\n(a)"]
    scripts = spark.createDataFrame([(str(i), f"CREATE VIEW d.v{c} AS SELECT 1") for i, c in enumerate(clauses)], "script_id string, sql string")
    outlined = cat._staged(scripts).select("script_id", "_outlined")
    plan = outlined._jdf.queryExecution().optimizedPlan().toString()
    assert all(plan.count(f"AS {step}#") == 1 for step in ("_top", "_pieces", "_groups", "_outlined"))
    found = {clauses[int(r["script_id"])]: r["_outlined"] for r in outlined.collect()}
    assert [found[c]["depth"] for c in clauses] == [0, 0, 0, 0, 0, 0, 1, 0]
    assert [[i["text"] for i in found[c]["items"]] for c in clauses[1:4]] == [[], ["a", "b"], ["a", "(b)", "x=[1, 2]"]]
