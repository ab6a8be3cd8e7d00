"""Corpora and graphs made from the benchmark tables.

The tables hold no SQL scripts, so a script is spelled from each order, and graphs are read from
the keys. The spelling is plain SQL text that any engine evaluates the same way.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
ROWS_A_TASK = 20_000
EDGE_COLUMNS = ("src_dataset", "src_object", "dep_dataset", "dep_object", "dep_type")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bound(sql: str) -> str:
    """The query with its table left open for a DataFrame; other braces stay text."""
    escaped = sql.replace("{", "{{").replace("}", "}}")
    return escaped.replace("FROM orders", "FROM {orders}")


def _spread(table: DataFrame) -> DataFrame:
    """Order keys over all cores: scripts are spelled from them behind this exchange. Two numbers
    a row move here, never a text. The tasks grow in number with the table, not in length; the rows are
    counted from the footers of its files."""
    tasks = math.ceil(table.count() / ROWS_A_TASK)
    return table.repartition(max(tasks, table.sparkSession.sparkContext.defaultParallelism))


# --- scripts ----------------------------------------------------------------------------------

NL = "chr(10)"
QUOTE = "chr(39)"
BACKSLASH = "chr(92)"


def text(value: str) -> str:
    """A SQL text expression for ``value``, with line ends, quotes and ``{n}`` holes.

    ``{k}`` and the like name SQL columns of the script query.
    """
    pieces, rest = [], value
    while rest:
        marks = [(rest.find(m), m) for m in ("\n", "'", "\\", "{") if m in rest]
        if not marks:
            pieces.append(f"'{rest}'")
            break
        at, mark = min(marks)
        if at:
            pieces.append(f"'{rest[:at]}'")
        if mark == "{":
            end = rest.index("}", at)
            pieces.append(f"CAST({rest[at + 1:end]} AS STRING)")
            rest = rest[end + 1:]
        else:
            pieces.append({"\n": NL, "'": QUOTE, "\\": BACKSLASH}[mark])
            rest = rest[at + 1:]
    return "concat(" + ", ".join(pieces or ["''"]) + ")"


# Numbers each script is spelled from. k is the order's key, h and t its half and third.
_NUMBERS = """
    SELECT o_orderkey AS k, o_custkey AS c,
           CAST(floor(o_orderkey / 2) AS BIGINT) AS h,
           CAST(floor(o_orderkey / 3) AS BIGINT) AS t,
           o_orderkey % 14 AS shape, o_orderkey % 7 AS ds,
           o_orderkey % 3 AS m3, o_orderkey % 90 AS m90, o_orderkey % 200 AS m200,
           repeat(' ', CAST(o_orderkey % 5 AS INT)) AS pad
    FROM orders
"""
NUMBERS_SQL = f"""
    SELECT *, h % 7 AS hd, t % 7 AS td,
           CASE m3 WHEN 0 THEN 'DETERMINISTIC AS (SELECT 1)' WHEN 1 THEN '; SELECT 1'
                   ELSE concat('AS', chr(10), '  (SELECT (1)') END AS broken
    FROM ({_NUMBERS}) AS numbers
"""

# The query all bodies share. Each line starts with the pad, so dedent has work to do.
_QUERY = """{pad}SELECT a.x, EXTRACT(DAY FROM a.ts) AS dy, -- reads dsc.vc({k})
{pad}  'dss.vs{k}' AS name, /* dsb.vb */ dsx.fn{k}(a.x) AS y
{pad}FROM ds{hd}.v{h} AS a, `ds{td}`.`v{t}` b
{pad}JOIN dsu.`missing{k}` ON a.x = b.x
{pad}LEFT JOIN ds{hd}.INFORMATION_SCHEMA.TABLES AS i ON true
{pad}WHERE a.x > (SELECT max(z) FROM other.ds{td}.w{k})
"""
_CALLS = """{pad}BEGIN
{pad}  DECLARE n INT64 DEFAULT CASE WHEN {m3} > 1 THEN 1 ELSE 2 END;
{pad}  IF n > 1 THEN
{pad}    CALL ds{hd}.v{h}(n);
{pad}  END IF;
{pad}  INSERT INTO dsu.missing{k} (x) SELECT IF(true, 1, 2) FROM ds{td}.v{t}(3);
{pad}  DELETE FROM `dsd.gone{k}` WHERE x = 'END';
{pad}END"""

_SHAPES = {
    0: """-- view {k}
CREATE OR REPLACE VIEW `ds{ds}.v{k}`
(
  key OPTIONS(description="key, of {k}"),
  total
) OPTIONS(
  description='it\\'s view {k}', friendly_name="v {k}",
  labels=[("band", "b{m3}"), ("src", 'o')]
) AS
""" + _QUERY + ";",
    1: """CREATE MATERIALIZED VIEW IF NOT EXISTS `ds{ds}`.v{k}
PARTITION BY DATE(created)
CLUSTER BY c{m3}, `key`
OPTIONS (enable_refresh = TRUE, allow_non_incremental_definition=false,
  refresh_interval_minutes={m90}, max_staleness=INTERVAL {m200} MINUTE,
  kms_key_name="projects/p/key{m3}", description="first", description='mat {k}')
AS
""" + _QUERY + ";",
    2: """/* function {k} */ CREATE FUNCTION proj.ds{ds}.v{k}(x INTEGER, y ARRAY<STRUCT<a BIGINT, b NUMERIC(10, 2)>>, z ANY TYPE)
RETURNS FLOAT
OPTIONS(description = 'fn {k}')
AS ((
""" + _QUERY + "));",
    3: """create or replace table function ds{ds}.v{k} (
  n smallint, src TABLE<plate STRING, at TIMESTAMP>
) RETURNS TABLE<id INT, name STRING> AS (
""" + _QUERY + ");",
    4: """CREATE AGGREGATE FUNCTION ds{ds}.v{k}(x double, w FLOAT64 NOT AGGREGATE)
RETURNS FLOAT64 AS ((
""" + _QUERY + "));",
    5: "CREATE OR REPLACE PROCEDURE ds{ds}.v{k}(IN a INT64, OUT b STRING, INOUT c BOOLEAN)\n"
    + _CALLS + ";",
    6: "CREATE TEMP FUNCTION ds{ds}.v{k}(x INT64) AS (x + {k});",
    7: "CREATE VIEW ds{ds}.v{k} AS (SELECT 1 AS x) UNION ALL (\n" + _QUERY + "); SELECT {k}",
    8: """CREATE MATERIALIZED VIEW ds{ds}.v{k} PARTITION BY day CLUSTER BY a
OPTIONS(max_staleness=INTERVAL "{m3}:{m90}:0" HOUR TO SECOND, enable_refresh=FALSE) AS
""" + _QUERY + ";",
    9: """CREATE FUNCTION `proj.ds{ds}`.v{k} (x FLOAT64)
RETURNS STRING
OPTIONS (max_batching_rows = {m90}, entry_point = 'main{m3}', runtime_version = "python-3.11",
  packages = ['numpy==1.{m3}', "pandas"], library=['gs://b/l{m3}.py'], container_cpu = 1)
LANGUAGE python
WITH CONNECTION `proj.us.conn{m3}`
AS r\'\'\'
def main{m3}(x):
  return ds{hd}.v{h}(x)
\'\'\';""",
    10: "CREATE TABLE FUNCTION ds{ds}.v{k}(n INT64) {broken}",
    11: """CREATE AGGREGATE FUNCTION ds{ds}.v{k}(x FLOAT64) RETURNS FLOAT64
LANGUAGE js OPTIONS (library = "gs://b/one.js", determinism_level = 'deterministic', data_governance_type = "Masking_{m3}")
AS R \"\"\"
  return "a" + 'b';
\"\"\"; ignored""",
    12: """CREATE PROCEDURE proj.ds{ds}.v{k}()
WITH CONNECTION `proj.us.spark{m3}`
OPTIONS (engine = "SPARK", runtime_version = '2.{m3}', main_file_uri = 'gs://b/main{k}.py',
  jar_uris = ['gs://b/a.jar', 'gs://b/b{m3}.jar'], properties = [("spark.x", "{m3}")])
LANGUAGE PYTHON""",
    13: """CREATE FUNCTION ds{ds}.v{k}(x BYTES) RETURNS BYTES
REMOTE WITH CONNECTION `proj.us.remote{m3}`
OPTIONS (endpoint = 'https://e/{k}', user_defined_context = [("mode", "m{m3}")],
  max_batching_rows = {m90});""",
}
SCRIPTS_SQL = (
    "SELECT CAST(k AS STRING) AS script_id, CASE shape "
    + " ".join(f"WHEN {shape} THEN {text(script)}" for shape, script in _SHAPES.items())
    + f" END AS sql FROM ({NUMBERS_SQL}) AS numbered"
)
BODIES_SQL = f"""
    SELECT CAST(k AS STRING) AS script_id, {text(_QUERY)} AS body,
           concat('ds', CAST(ds AS STRING)) AS dataset_id,
           concat('v', CAST(k AS STRING)) AS object_id
    FROM ({NUMBERS_SQL}) AS numbered
"""
PLACEHOLDERS_SQL = f"""
    SELECT CAST(k AS STRING) AS script_id,
           {text("SELECT '${project}' FROM `${project}`.ds.v{k}").replace("CAST(project AS STRING)", "'{project}'")}
               AS body,
           CASE m3 WHEN 0 THEN '' WHEN 1 THEN concat('p', CAST(k AS STRING)) END AS project
    FROM ({NUMBERS_SQL}) AS numbered
"""


# --- scripts and bodies spelled from the digits of a mixed radix ----------------------------------

# What a body begins with, the relations it lists, and what follows them.
_HEADS = (
    "SELECT a FROM ", "SELECT EXTRACT(DAY FROM x.y) FROM ",
    "SELECT EXTRACT(YEAR FROM (SELECT max(EXTRACT(DAY FROM z.t)) FROM q.r)) FROM ",
    "MERGE ds{ds}.m{k} t USING ", "MERGE INTO `dsj.m{k}` AS t USING ",
    "DELETE FROM ds{ds}.d{k} WHERE x IN (SELECT y FROM ", "INSERT INTO ds{ds}.n{k} (a, b) SELECT a, b FROM ",
    "UPDATE ds{ds}.u{k} SET a = dsf.fn(b) FROM ", "CALL ds{ds}.p{k}(1); SELECT * FROM ",
)
_LISTS = (
    "ds{ds}.v{h}", "`ds{td}.w{k}`", "ds{ds}.a{k} AS q, ds{td}.b{k} r, `x{m3}`.`y` z",
    "proj.ds{td}.t{k} AS a, UNNEST(a.xs) u, dsx.no{k}", "ds{ds}.f{k}(1) AS f, ds{td}.g",
    "(SELECT * FROM dsn.inner{k} i) s, ds{td}.after{k}",
    "ds{ds}.INFORMATION_SCHEMA.TABLES t, p.ds{td}.INFORMATION_SCHEMA.COLUMNS",
)
_TAILS = (
    "", " WHERE dsf.check{k}(x)", " JOIN ds{td}.j{k} AS j USING (x, y)", " LEFT JOIN `dsj`.j{k} ON a.b = c.d",
    " ON t.x = s.y WHEN MATCHED THEN UPDATE SET x = s.z WHEN NOT MATCHED THEN INSERT (a) VALUES (dsf.v(1))",
    " GROUP BY dsg.x ORDER BY 1; TRUNCATE TABLE ds{ds}.tr{k}", " QUALIFY RANK() OVER (PARTITION BY a.b) = 1 -- FROM dsc.c\n",
)
_JOINTS = (" ", "\n", " /* FROM dsc.x, dsc.y */ ", ", 'FROM dsq.z' AS s ")
# Statements that hold others in their middle, and those that hold none.
_NESTS = (
    "IF x > 1 THEN {} END IF;", "LOOP {} LEAVE; END LOOP;", "WHILE x < 3 DO\n{}\nEND WHILE;",
    "FOR r IN (SELECT 1 AS y) DO {} END FOR;", "BEGIN\n  {}\nEND;", "REPEAT {} UNTIL x > 2 END REPEAT;",
    "IF a THEN SELECT 1; ELSEIF b THEN {} ELSE SELECT IF(a, 1, 2); END IF;",
)
_LEAVES = (
    "SET x = CASE WHEN a THEN 1 ELSE 2 END;", "SELECT IF(a, 'END', \"BEGIN\") FROM t;", "CALL ds{ds}.p{k}(1);",
    "-- END;\nSELECT `end` FROM t;",
)
_ARGUMENT_MODES = ("", "IN ", "OUT ", "INOUT ")
# Argument types as written and as they are returned.
ARGUMENT_TYPES = (
    ("INT64", "INT64"), ("string", "STRING"), ("ARRAY<STRUCT<a INT, b ARRAY<STRING>>>", "ARRAY<STRUCT<a INT64, b ARRAY<STRING>>>"),
    ("NUMERIC(10, 2)", "NUMERIC"), ("STRUCT<x BOOLEAN, y DEC>", "STRUCT<x BOOL, y NUMERIC>"),
)


def _digits(*bases: int) -> list[str]:
    """The digits of ``k`` in a mixed radix, as SQL."""
    out, below = [], 1
    for base in bases:
        out.append(f"(CAST(floor(k / {below}) AS BIGINT) % {base})")
        below *= base
    return out


def _chosen(digit: str, options) -> str:
    return f"CASE {digit} " + " ".join(f"WHEN {i} THEN {text(o)}" for i, o in enumerate(options)) + " END"


def _nested(digits: list[str], leaf: str) -> str:
    """Statements within statements, the outermost chosen by the first digit."""
    inner = leaf
    for digit in reversed(digits):
        before, behind = zip(*(nest.split("{}") for nest in _NESTS))
        inner = f"concat({_chosen(digit, before)}, {inner}, {_chosen(digit, behind)})"
    return inner


_HEAD, _LIST, _TAIL, _JOINT, _SECOND = _digits(9, 7, 7, 4, 7)
MIXED_BODIES_SQL = f"""
    SELECT CAST(k AS STRING) AS script_id,
           concat({_chosen(_HEAD, _HEADS)}, {_chosen(_LIST, _LISTS)}, {_chosen(_TAIL, _TAILS)}, {_chosen(_JOINT, _JOINTS)},
                  'SELECT 1 FROM ', {_chosen(_SECOND, _LISTS)}) AS body
    FROM ({NUMBERS_SQL}) AS numbered
"""
_LEVELS = _digits(7, 7, 7, 4)
MIXED_BLOCK = f"concat('BEGIN ', {_nested(_LEVELS[:3], _chosen(_LEVELS[3], _LEAVES))}, {NL}, 'END')"
ARGUMENT_COUNT = "k % 4"


def argument_type(place: int, written: bool) -> str:
    digit = f"(CAST(floor(k / {4 * 5**place}) AS BIGINT) % 5)"
    return _chosen(digit, [pair[0 if written else 1] for pair in ARGUMENT_TYPES])


def argument_mode(place: int) -> str:
    return _chosen(f"(CAST(floor(k / {3 * 4**place}) AS BIGINT) % 4)", _ARGUMENT_MODES)


def _mixed_argument(place: int) -> str:
    comma = "', '" if place else "''"
    spelled = f"concat({comma}, {argument_mode(place)}, 'a{place} ', {argument_type(place, True)})"
    return f"CASE WHEN {ARGUMENT_COUNT} > {place} THEN {spelled} ELSE '' END"


MIXED_SCRIPTS_SQL = f"""
    SELECT CAST(k AS STRING) AS script_id,
           concat('CREATE PROCEDURE ds', CAST(ds AS STRING), '.p', CAST(k AS STRING), '(', {_mixed_argument(0)},
                  {_mixed_argument(1)}, {_mixed_argument(2)}, ')', {NL}, {MIXED_BLOCK}, '; SELECT 2') AS sql
    FROM ({NUMBERS_SQL}) AS numbered
"""


def mixed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per order: a head, a list of relations, a tail and a second query, each by a digit of the key."""
    return order_bodies(spark, sf_dir, MIXED_BODIES_SQL)


def mixed_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One procedure per order: statements three deep and up to three arguments, by digits of the key."""
    return order_bodies(spark, sf_dir, MIXED_SCRIPTS_SQL)


def order_bodies(spark: SparkSession, sf_dir: str, sql: str = BODIES_SQL) -> DataFrame:
    """The shared query of the scripts alone, one per order, indented by zero to four blanks."""
    orders = _spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return spark.sql(_bound(sql), orders=orders)


def order_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One script per order: 14 shapes over all six kinds, with some to reject."""
    orders = _spread(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return spark.sql(_bound(SCRIPTS_SQL), orders=orders)


# --- free text --------------------------------------------------------------------------------

FREE_TEXT_SQL = """
    SELECT concat('d', CAST(doc_id AS STRING)) AS script_id, text AS body FROM documents
    UNION ALL SELECT concat('p', CAST(page_id AS STRING)), html FROM pages
    UNION ALL SELECT concat('c', CAST(conv_id AS STRING), '-', CAST(turn AS STRING)), text
    FROM conversations
"""


def free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, pages and conversation turns as bodies with no home dataset."""
    sql, tables = FREE_TEXT_SQL, {}
    for name in ("documents", "pages", "conversations"):
        tables[name] = read_table(spark, sf_dir, name)
        sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(sql, **tables)


# --- graphs -----------------------------------------------------------------------------------

CHAIN_NODES_SQL = """
    SELECT 'shop' AS dataset_id, concat('o', CAST(o_orderkey AS STRING)) AS object_id,
           'VIEW' AS object_type
    FROM orders
"""
CHAIN_EDGES_SQL = """
    SELECT 'shop' AS src_dataset, concat('o', CAST(o_orderkey AS STRING)) AS src_object,
           'shop' AS dep_dataset, concat('o', CAST(previous AS STRING)) AS dep_object,
           'VIEW' AS dep_type
    FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey)
                 AS previous
          FROM orders) AS chained
    WHERE previous IS NOT NULL
"""
TURN_NODES_SQL = """
    SELECT concat('c', CAST(conv_id AS STRING)) AS dataset_id,
           concat('t', CAST(turn AS STRING)) AS object_id, 'SCALAR_FUNCTION' AS object_type
    FROM conversations
"""
TURN_EDGES_SQL = """
    SELECT concat('c', CAST(conv_id AS STRING)) AS src_dataset,
           concat('t', CAST(turn AS STRING)) AS src_object,
           concat('c', CAST(conv_id AS STRING)) AS dep_dataset,
           concat('t', CAST(turn - 1 AS STRING)) AS dep_object, 'SCALAR_FUNCTION' AS dep_type
    FROM conversations
"""

# Every order line depends on one hub and on the line before it: more than a third of all edges have one end.
HOT_NODES_SQL = """
    SELECT DISTINCT concat('o', CAST(l_orderkey AS STRING)) AS dataset_id,
           concat('l', CAST(l_linenumber AS STRING)) AS object_id, 'VIEW' AS object_type
    FROM lineitem
    UNION ALL SELECT 'hub', 'hub', 'VIEW' FROM region WHERE r_regionkey = 0
"""
HOT_EDGES_SQL = """
    SELECT concat('o', CAST(l_orderkey AS STRING)) AS src_dataset,
           concat('l', CAST(l_linenumber AS STRING)) AS src_object, 'hub' AS dep_dataset,
           'hub' AS dep_object, 'VIEW' AS dep_type
    FROM lineitem
    UNION ALL
    SELECT concat('o', CAST(l_orderkey AS STRING)), concat('l', CAST(l_linenumber AS STRING)),
           concat('o', CAST(l_orderkey AS STRING)), concat('l', CAST(l_linenumber - 1 AS STRING)), 'VIEW'
    FROM lineitem
"""


def _key(prefix: str, *columns: str) -> str:
    joined = ", '-', ".join(f"CAST({c} AS STRING)" for c in columns)
    return f"concat('{prefix}', {joined})"


_STAR = {
    "part": _key("p", "p_partkey"),
    "region": _key("r", "r_regionkey"),
    "nation": _key("n", "n_nationkey"),
    "customer": _key("c", "c_custkey"),
    "supplier": _key("s", "s_suppkey"),
    "orders": _key("o", "o_orderkey"),
    "lineitem": _key("l", "l_orderkey", "l_linenumber"),
}
_STAR_LINKS = (
    ("nation", "region", _key("r", "n_regionkey")),
    ("customer", "nation", _key("n", "c_nationkey")),
    ("supplier", "nation", _key("n", "s_nationkey")),
    ("orders", "customer", _key("c", "o_custkey")),
    ("lineitem", "orders", _key("o", "l_orderkey")),
    ("lineitem", "part", _key("p", "l_partkey")),
    ("lineitem", "supplier", _key("s", "l_suppkey")),
)
STAR_NODES_SQL = " UNION ALL ".join(
    f"SELECT DISTINCT '{table}' AS dataset_id, {key} AS object_id, 'TABLE_VALUED_FUNCTION'"
    f" AS object_type FROM {table}"
    for table, key in _STAR.items()
)
STAR_EDGES_SQL = " UNION ALL ".join(
    f"SELECT '{src}' AS src_dataset, {_STAR[src]} AS src_object, '{dep}' AS dep_dataset,"
    f" {key} AS dep_object, 'VIEW' AS dep_type FROM {src}"
    for src, dep, key in _STAR_LINKS
)


def from_tables(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run one of the queries above on the tables of ``sf_dir``."""
    used = {}
    for name in TABLES:
        if f"FROM {name}" in sql:
            used[name] = read_table(spark, sf_dir, name)
            sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(sql, **used)
