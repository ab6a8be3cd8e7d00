"""The same results as SQL for DuckDB.

Two kinds. For the scripts spelled from orders the SQL states what each spelling must give, from
the numbers it was spelled with, and never looks at a script's text. For free text and for graphs
the SQL works the result out another way: tokens with windows over them, recursive queries.
"""

from __future__ import annotations

from scriptloom.sources import corpora
from scriptloom.sources.corpora import NUMBERS_SQL, text

_N = f"({NUMBERS_SQL}) AS n"
_ID = "CAST(k AS STRING) AS script_id"
_OK = "shape NOT IN (6, 10)"
_VIEWS = "shape IN (0, 1, 7, 8)"
_MATERIALIZED = "shape IN (1, 8)"
_ROUTINES = "shape IN (2, 3, 4, 5, 9, 11, 12, 13)"
_PROJ = "shape IN (2, 9, 12)"

_KIND = """CASE WHEN shape IN (0, 7) THEN 'VIEW' WHEN shape IN (1, 8) THEN 'MATERIALIZED_VIEW'
    WHEN shape IN (2, 6, 9, 13) THEN 'SCALAR_FUNCTION'
    WHEN shape IN (3, 10) THEN 'TABLE_VALUED_FUNCTION'
    WHEN shape IN (4, 11) THEN 'AGGREGATE_FUNCTION' ELSE 'PROCEDURE' END"""
_REASON = """CASE WHEN shape = 6 THEN 'temporary object' WHEN m3 = 2 THEN 'unclosed body'
    ELSE 'malformed header' END"""

# Where reading stopped: at the statement, at the end of the header, or at the open paren on line 2.
_OFFSET = """CASE WHEN shape = 6 THEN 0 ELSE length('CREATE TABLE FUNCTION ds' || ds || '.v' || k
    || '(n INT64) ') + CASE m3 WHEN 0 THEN length('DETERMINISTIC ') WHEN 1 THEN length('; SELECT 1')
    ELSE length('AS') + 1 + length('  ') END END"""
_SECOND_LINE = "shape = 10 AND m3 = 2"
_REJECTED = (
    f"CAST(k AS STRING) AS script_id, {_REASON} AS reason, CAST({_OFFSET} AS BIGINT) AS \"offset\","
    f" CAST(CASE WHEN {_SECOND_LINE} THEN 2 ELSE 1 END AS BIGINT) AS line,"
    f" CAST(CASE WHEN {_SECOND_LINE} THEN 3 ELSE {_OFFSET} + 1 END AS BIGINT) AS \"column\""
)


def _select(columns: str, where: str = "true", source: str = _N) -> str:
    return f"SELECT {columns} FROM {source} WHERE {where}"


def _union(*selects: str) -> str:
    return " UNION ALL ".join(selects)


def _list_rows(columns: str, rows: list[tuple[str, ...]]) -> str:
    """Rows ``(where, column, ...)`` with the script id in front."""
    names = columns.split(", ")
    return _union(
        *[
            _select(
                f"{_ID}, " + ", ".join(f"{v} AS {c}" for v, c in zip(row[1:], names)), row[0]
            )
            for row in rows
        ]
    )


def _q(value: str) -> str:
    return text(value)


# --- bodies -----------------------------------------------------------------------------------

_NO_PAD = f"(SELECT * REPLACE ('' AS pad) FROM {_N}) AS n"
_LINE = "--[^\\n]*"
_STRINGS = (
    r"""'''[\s\S]*?(?:'''|\z)|\"\"\"[\s\S]*?(?:\"\"\"|\z)"""
    r"""|'(?:[^'\\]|\\[\s\S])*(?:'|\\?\z)|"(?:[^"\\]|\\[\s\S])*(?:"|\\?\z)"""
)


def _lit(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_COMMENTS = _lit(
    rf"({_STRINGS}|`[^`]*`?)|{_LINE}".replace("\\n", "\n").replace('\\"', '"')
    + r"|/\*(?:[\s\S]*?\*/|[\s\S]*([\s\S])\z|)"
)
_WHITE_SPACE = (
    "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"
    " || chr(5760) || " + " || ".join(f"chr({c})" for c in range(8192, 8203))
    + " || chr(8232) || chr(8233) || chr(8239) || chr(8287) || chr(12288)"
)
_FREE = f"({corpora.FREE_TEXT_SQL}) AS free"

_QUERY_TEXT = text(corpora._QUERY)
_BODY = {
    0: f"{corpora.NL} || {_QUERY_TEXT}",
    1: f"{corpora.NL} || {_QUERY_TEXT}",
    2: f"'(' || {corpora.NL} || {_QUERY_TEXT} || ')'",
    3: f"{corpora.NL} || {_QUERY_TEXT}",
    4: f"'(' || {corpora.NL} || {_QUERY_TEXT} || ')'",
    5: f"trim({text(corpora._CALLS)}, ' ')",
    7: f"' (SELECT 1 AS x) UNION ALL (' || {corpora.NL} || {_QUERY_TEXT} || ')'",
    8: f"{corpora.NL} || {_QUERY_TEXT}",
    9: text("\ndef main{m3}(x):\n  return ds{hd}.v{h}(x)\n"),
    11: text("\n  return \"a\" + 'b';\n"),
    12: "''",
    13: "''",
}
# A statement body starts on the line of its first word: the line end after AS is not part of it.
for _shape in (0, 1, 8):
    _BODY[_shape] = _QUERY_TEXT


def _case(texts: dict[int, str]) -> str:
    return "CASE shape " + " ".join(f"WHEN {s} THEN {t}" for s, t in texts.items()) + " END"


def _rewritten(project: str, where: str) -> str:
    """Bodies of the routines with the project put in, spelled with the project in place."""

    def name(dataset: str, obj: str) -> str:
        return (
            f"CASE WHEN {dataset} = 'ds' || ds THEN {{plain}} ELSE '`' || {project} || '`.`' || "
            f"{dataset} || '`.`' || {obj} || '`' END"
        )

    half = name("'ds' || hd", "'v' || h").format(plain="'ds' || hd || '.v' || h")
    third = name("'ds' || td", "'v' || t").format(plain="'`ds' || td || '`.`v' || t || '`'")
    third_call = name("'ds' || td", "'v' || t").format(plain="'ds' || td || '.v' || t")
    info = (
        f"CASE WHEN hd = ds THEN 'ds' || hd ELSE '`' || {project} || '`.`ds' || hd || '`' END"
        " || '.INFORMATION_SCHEMA.TABLES'"
    )
    always = {
        "dsx.fn{k}": f"'`' || {project} || '`.`dsx`.`fn' || k || '`'",
        "dsu.`missing{k}`": f"'`' || {project} || '`.`dsu`.`missing' || k || '`'",
        "dsu.missing{k}": f"'`' || {project} || '`.`dsu`.`missing' || k || '`'",
        "`dsd.gone{k}`": f"'`' || {project} || '`.`dsd`.`gone' || k || '`'",
    }
    fixed = always | {
        "ds{hd}.v{h}": half,
        "`ds{td}`.`v{t}`": third,
        "ds{td}.v{t}": third_call,
        "ds{hd}.INFORMATION_SCHEMA.TABLES": info,
    }

    def spelled(template: str) -> str:
        for i, written in enumerate(fixed):
            template = template.replace(written, f"{{@{i}}}")
        sql = text(template)
        for i, replacement in enumerate(fixed.values()):
            sql = sql.replace(f"CAST(@{i} AS STRING)", f"({replacement})")
        return sql

    # Indentation is gone: on every line, or where the body starts with "(" on none.
    plain, padded = spelled(corpora._QUERY.replace("{pad}", "")), spelled(corpora._QUERY)
    calls = spelled(corpora._CALLS.replace("{pad}BEGIN", "BEGIN", 1))
    bodies = {
        2: f"'(' || {corpora.NL} || {padded} || ')'",
        3: f"rtrim({plain}, {corpora.NL})",
        4: f"'(' || {corpora.NL} || {padded} || ')'",
        5: calls,
        9: spelled("def main{m3}(x):\n  return ds{hd}.v{h}(x)"),
        11: text("return \"a\" + 'b';"),
        12: "''",
        13: "''",
    }
    return _select(f"{_ID}, {_case(bodies)} AS body", where)


# --- names in the scripts ---------------------------------------------------------------------

_QUERY_SHAPES = "shape IN (0, 1, 2, 3, 4, 7, 8)"
# (shapes, position, dataset, object, type, has_project, metadata)
_NAMES = [
    (_QUERY_SHAPES, 1, "'dsx'", "'fn' || k", "SCALAR_FUNCTION", "false", "false"),
    (_QUERY_SHAPES, 2, "'ds' || hd", "'v' || h", "VIEW", "false", "false"),
    (_QUERY_SHAPES, 3, "'ds' || td", "'v' || t", "VIEW", "false", "false"),
    (_QUERY_SHAPES, 4, "'dsu'", "'missing' || k", "VIEW", "false", "false"),
    (_QUERY_SHAPES, 5, "'ds' || hd", "'INFORMATION_SCHEMA.TABLES'", "TABLE", "false", "true"),
    (_QUERY_SHAPES, 6, "'ds' || td", "'w' || k", "VIEW", "true", "false"),
    ("shape = 5", 1, "'ds' || hd", "'v' || h", "PROCEDURE", "false", "false"),
    ("shape = 5", 2, "'dsu'", "'missing' || k", "VIEW", "false", "false"),
    ("shape = 5", 3, "'ds' || td", "'v' || t", "TABLE_VALUED_FUNCTION", "false", "false"),
    ("shape = 5", 4, "'dsd'", "'gone' || k", "VIEW", "false", "false"),
    ("shape = 9", 1, "'ds' || hd", "'v' || h", "SCALAR_FUNCTION", "false", "false"),
]
_NAMES_SQL = _union(
    *[
        _select(
            f"{_ID}, k, ds, shape, CAST({pos} AS BIGINT) AS position, {dataset} AS dataset_id,"
            f" {obj} AS object_id, '{kind}' AS object_type, {project} AS has_project,"
            f" {metadata} AS metadata",
            shapes,
        )
        for shapes, pos, dataset, obj, kind, project, metadata in _NAMES
    ]
)
_FIRST_SQL = f"""
    SELECT script_id, k, ds, dataset_id, object_id, object_type, position FROM ({_NAMES_SQL}) AS x
    WHERE NOT (dataset_id = 'ds' || ds AND object_id = 'v' || k)
    QUALIFY row_number() OVER (PARTITION BY script_id, dataset_id, object_id ORDER BY position) = 1
"""
_REFERENCES_SQL = f"""
    SELECT script_id, dataset_id, object_id, object_type,
           CASE WHEN object_type IN ('VIEW', 'TABLE') THEN 'VIEW' ELSE 'ROUTINE' END
               AS resource_type
    FROM ({_FIRST_SQL}) AS firsts
"""
_FOREIGN_SQL = f"""
    SELECT DISTINCT script_id, dataset_id FROM ({_NAMES_SQL}) AS x WHERE dataset_id != 'ds' || ds
"""
_EDGES_SQL = f"""
    SELECT f.k AS src_k, 'ds' || f.ds || '.v' || f.k AS src, f.dataset_id || '.' || f.object_id AS dep,
           CAST(substr(f.object_id, 2) AS BIGINT) AS dep_k
    FROM ({_FIRST_SQL}) AS f
    WHERE f.object_type != 'TABLE' AND regexp_matches(f.object_id, '^v[0-9]+$')
      AND CAST(substr(f.object_id, 2) AS BIGINT) % 14 NOT IN (6, 10)
"""

# --- tokens -----------------------------------------------------------------------------------

_BARE = r"[A-Za-z_][A-Za-z0-9_-]*"
_QUOTED_PART = r"[\p{L}_][\p{L}\p{Nd}_-]*"
_ALL_GAP = r"(?:[ \t\n\r]|--[^\n]*|/\*(?:[^*]|\*+[^*/])*\*+/|/\*[\s\S]*\z)+"
# Before something else a gap must not end inside a comment, so comments are spelled to their end.
_GAP1 = r"(?:[ \t\n\r]|--[^\n]*\n|/\*(?:[^*]|\*+[^*/])*\*+/)+"
_GAP = _GAP1[:-1] + "*"
_FIRST_PART = rf"(?:{_BARE}|`[^`.]*`)"
_PART = rf"(?:{_BARE}|`{_QUOTED_PART}`)"
_NAME_TAIL = rf"(?:\(|{_GAP}\.)?"
# This engine's patterns have no lookahead: gaps are tokens of their own, names are read at full
# length, and both are put right afterwards.
_TOKEN = (
    _STRINGS.replace('\\"', '"')
    + rf"|{_GAP1},|,|{_ALL_GAP}"
    + rf"|`{_QUOTED_PART}(?:\.{_QUOTED_PART}){{1,2}}`{_NAME_TAIL}"
    + rf"|{_FIRST_PART}(?:{_GAP}\.{_GAP}{_PART})+{_NAME_TAIL}"
    + rf"|{_FIRST_PART}{_GAP}\.|`[^`.]*`|{_BARE}"
    + r"""|[();]|[^A-Za-z_'"`(),;\s/-]+|[\s\S]"""
)
_LAST_THREE = rf"({_PART}{_GAP}\.{_GAP}{_PART}{_GAP}\.{_GAP}{_PART}{_NAME_TAIL})\z"


def _tokens_sql(source: str) -> str:
    """All tokens in order. Of a name with more than three parts, those before the last three
    are words and dots by themselves, unless it names a metadata table."""
    return f"""
    SELECT script_id, token,
           row_number() OVER (PARTITION BY script_id ORDER BY place, sub) AS position
    FROM (
      SELECT script_id, place, unnest(pieces) AS token, generate_subscripts(pieces, 1) AS sub
      FROM (
        SELECT script_id, place,
          CASE WHEN long AND NOT (len(parts) = 4 AND
                 upper(replace(parts[3], '`', '')) = 'INFORMATION_SCHEMA')
               THEN list_concat(
                 flatten(list_transform(parts[1:len(parts) - 3], lambda p: [p, '.'])),
                 [regexp_extract(token, {_lit(_LAST_THREE)}, 1)])
               ELSE [token] END AS pieces
        FROM (
          SELECT *, regexp_matches(token, '^[A-Za-z_`]') AND len(parts) > 3 AS long
          FROM (
            SELECT script_id, token, place,
                   CASE WHEN contains(token, '.')
                        THEN regexp_extract_all(token, {_lit(_PART)}) ELSE [] END AS parts
            FROM (
              SELECT script_id, unnest(found) AS token, generate_subscripts(found, 1) AS place
              FROM (SELECT script_id, regexp_extract_all(body, {_lit(_TOKEN)}) AS found
                    FROM {source}) AS matched
            ) AS listed
          ) AS split
        ) AS sized
      ) AS cut
    ) AS each_one
    WHERE NOT regexp_full_match(token, {_lit(_ALL_GAP)})
    """


# --- names in free text: each token as one letter, a clause and all it announces as one match ------

# Words of bodies by what they do to the names behind them.
_LETTERS = {
    "1": "FROM", "2": "JOIN", "3": "INTO UPDATE DELETE TRUNCATE", "4": "USING MERGE", "5": "CALL", "a": "AS",
    "x": "EXTRACT", "y": "UNNEST WITH", "z": "ON WHERE GROUP ORDER LIMIT HAVING SET VALUES",
    # passing words that are no alias, and those that may be one
    "P": "LEFT RIGHT FULL INNER CROSS OUTER BEGIN END IF THEN ELSE LOOP WHILE FOR WHEN UNION INTERSECT EXCEPT"
    " QUALIFY WINDOW",
    "p": "TABLE BY SELECT DEFAULT DECLARE ELSEIF DO IN AND OR NOT TRUE FALSE NULL CASE MATCHED INSERT",
}
_NEVER_ALIAS = " ".join(_LETTERS[x] for x in "245zP").split()
# Letters of names: n name, j joined by backticks around all, c and k the same before a paren, d and e before
# a loose dot, o one part before a dot, s one part in backticks; a capital begins with a word of _NEVER_ALIAS.
_PASSED = "[gqpPaxf,l]"
_DUE = "[wsnNj]"
_ANY_ALIAS, _PLAIN_ALIAS, _CUT = "[x12345zywpPafsj]", "[wpyx13fsj]", "[ncdkeo]"
_ENTRY = rf"{_DUE}(?:(?:a{_ANY_ALIAS}|{_PLAIN_ALIAS}),|a[,l]|[,l])"
_LAST_ENTRY = rf"{_DUE}(?:a{_ANY_ALIAS}|a[ncdkeoNCDEO]|{_PLAIN_ALIAS}|{_CUT}|a)?"
_STRETCH = rf"[12345]{_PASSED}*(?:{_ENTRY}{_PASSED}*)*(?:{_LAST_ENTRY}|[cdekCDE])?"
_PIECE = rf"{_ENTRY}|{_LAST_ENTRY}|."


def _letters_sql() -> str:
    def words(names: str) -> str:
        return ", ".join(f"'{w}'" for w in names.split())

    bare = " ".join(f"WHEN upper(token) IN ({words(names)}) THEN '{letter}'" for letter, names in _LETTERS.items())
    first = f"upper(regexp_extract(token, '^{_BARE}')) IN ({words(' '.join(_NEVER_ALIAS))})"

    def by_tail(plain: str, call: str, dot: str) -> str:
        return f"CASE right(token, 1) WHEN '(' THEN '{call}' WHEN '.' THEN '{dot}' ELSE '{plain}' END"

    return f"""
      CASE WHEN regexp_matches(token, '^[A-Za-z_]') AND NOT contains(token, '.') THEN CASE {bare} ELSE 'w' END
           WHEN token IN (',', '(', ')', ';') THEN token
           WHEN token[1] IN (chr(39), '"') THEN 'q'
           WHEN regexp_matches(token, '^[A-Za-z_]') OR (token[1] = '`' AND length(token) > 1) THEN
             CASE WHEN NOT contains(token, '.') THEN 's'
                  WHEN regexp_full_match(token, {_lit(_FIRST_PART + _GAP + "[.]")}) THEN
                    CASE WHEN {first} THEN 'O' ELSE 'o' END
                  WHEN regexp_matches(token, '^`[^`.]*\\.[^`.]*`') OR regexp_matches(token, '^`[^`.]*\\.[^`.]*\\.[^`.]*`')
                    THEN {by_tail('j', 'k', 'e')}
                  WHEN {first} THEN {by_tail('N', 'C', 'D')}
                  ELSE {by_tail('n', 'c', 'd')} END
           WHEN right(token, 1) = ',' THEN 'l' ELSE 'g' END"""


def _free_names_sql(source: str) -> str:
    """The names of bodies. Every token becomes a letter; a clause word and what it announces is one
    match in the row of letters, whose pieces are names with their aliases. FROM within EXTRACT( counts
    for nothing."""
    return f"""
    WITH tokens AS (SELECT * FROM ({_tokens_sql(source)}) AS t),
    lettered AS (SELECT script_id, position, token, {_letters_sql()} AS letter FROM tokens),
    sums AS (
      SELECT *, sum(CASE WHEN letter IN ('(', 'c', 'C', 'k') THEN 1 WHEN letter = ')' THEN -1 ELSE 0 END)
                  OVER by_place AS total,
             lag(letter) OVER by_place AS before
      FROM lettered WINDOW by_place AS (PARTITION BY script_id ORDER BY position)
    ),
    deep AS (
      SELECT *, total - least(0, min(total) OVER (PARTITION BY script_id ORDER BY position)) AS depth FROM sums
    ),
    opened AS (
      SELECT o.script_id, o.position AS since,
             coalesce((SELECT min(c.position) FROM deep AS c WHERE c.script_id = o.script_id
                       AND c.position > o.position AND c.depth < o.depth), 9223372036854775807) AS upto
      FROM deep AS o WHERE o.letter = '(' AND o.before = 'x'
    ),
    placed AS (
      SELECT script_id, position,
             CASE WHEN letter = '1' AND EXISTS (SELECT 1 FROM opened AS o WHERE o.script_id = d.script_id
                       AND d.position > o.since AND d.position < o.upto) THEN 'f' ELSE letter END AS letter
      FROM deep AS d
    ),
    rows_of_letters AS (SELECT script_id, string_agg(letter, '' ORDER BY position) AS letters FROM placed GROUP BY script_id),
    stretches AS (
      SELECT script_id, unnest(found) AS stretch, generate_subscripts(found, 1) AS i
      FROM (SELECT script_id, regexp_extract_all(letters, {_lit(_STRETCH + "|.")}) AS found FROM rows_of_letters) AS x
    ),
    begun AS (
      SELECT *, sum(length(stretch)) OVER (PARTITION BY script_id ORDER BY i) - length(stretch) AS passed FROM stretches
    ),
    pieces AS (
      SELECT script_id, stretch, passed, unnest(found) AS piece, generate_subscripts(found, 1) AS j
      FROM (SELECT *, regexp_extract_all(stretch[2:], {_lit(_PIECE)}) AS found FROM begun WHERE length(stretch) > 1) AS x
    ),
    put AS (
      SELECT *, passed + 1 + sum(length(piece)) OVER (PARTITION BY script_id, passed ORDER BY j) AS upto FROM pieces
    ),
    kept AS (
      SELECT script_id, passed + 1 AS position, '' AS role, stretch AS letter, false AS cut
      FROM begun WHERE stretch IN ('c', 'C', 'k')
      UNION ALL
      SELECT script_id, upto - length(piece) + 1, stretch[1], piece[1], false FROM put
      WHERE piece[1] IN ('n', 'N', 'j', 'c', 'C', 'd', 'D', 'e', 'k')
      UNION ALL
      SELECT script_id, upto, '', piece[-1], true FROM put WHERE length(piece) > 1 AND piece[-1] IN ('c', 'C')
    ),
    spelled AS (
      SELECT k.script_id, k.position, k.role, k.letter,
             CASE WHEN k.cut THEN regexp_replace(t.token, {_lit("^" + _FIRST_PART + _GAP + "[.]" + _GAP)}, '')
                  ELSE t.token END AS token, k.cut
      FROM kept AS k JOIN tokens AS t USING (script_id, position)
    ),
    parted AS (
      SELECT *, CASE WHEN letter IN ('j', 'k', 'e') THEN string_split(regexp_extract(token, '^`([^`]*)`', 1), '.')
                     ELSE list_transform(list_filter(regexp_extract_all(token, {_lit("(`[^`]*`|" + _BARE + ")|" + _GAP1)}, 1),
                                                     lambda p: p <> ''), lambda p: replace(p, '`', '')) END AS parts
      FROM spelled WHERE NOT cut OR contains(token, '.')
    ),
    named AS (
      SELECT *, len(parts) AS size,
             len(parts) = 3 AND upper(parts[2]) = 'INFORMATION_SCHEMA' AND letter NOT IN ('j', 'k', 'e') AS metadata
      FROM parted
    ),
    read_out AS (
      SELECT *, CASE WHEN size = 2 OR metadata THEN parts[1] ELSE parts[2] END AS dataset_id,
             CASE WHEN size = 4 THEN parts[3] || '.' || parts[4] WHEN metadata THEN parts[2] || '.' || parts[3]
                  WHEN size = 3 THEN parts[3] ELSE parts[2] END AS object_id,
             right(token, 1) = '(' AS called
      FROM named
    )
    SELECT script_id, row_number() OVER (PARTITION BY script_id ORDER BY position) AS position, dataset_id, object_id,
           CASE WHEN role = '5' THEN 'PROCEDURE'
                WHEN role IN ('1', '2') AND called THEN 'TABLE_VALUED_FUNCTION'
                WHEN role <> '' AND NOT called THEN
                  CASE WHEN contains(upper(object_id), 'INFORMATION_SCHEMA') THEN 'TABLE' ELSE 'VIEW' END
                ELSE 'SCALAR_FUNCTION' END AS object_type,
           size > 2 AND NOT metadata AS has_project, metadata
    FROM read_out"""


def oracle_sql() -> dict[str, str]:
    layer_columns = (
        "layer, dataset_id, object_id, object_type,"
        " CASE WHEN object_type IN ('VIEW', 'MATERIALIZED_VIEW') THEN 'VIEW' ELSE 'ROUTINE' END"
        " AS resource_type, dataset_id || '.' || object_id AS reference_id"
    )

    def deepest(nodes: str, edges: str) -> str:
        return f"""
        WITH RECURSIVE nodes AS ({nodes}), edges AS ({edges}),
        known AS (
          SELECT DISTINCT e.src_dataset AS sd, e.src_object AS so, e.dep_dataset AS dd,
                 e.dep_object AS dobj
          FROM edges e JOIN nodes d ON d.dataset_id = e.dep_dataset AND d.object_id = e.dep_object
        ),
        walk(dataset_id, object_id, layer) AS (
          SELECT dataset_id, object_id, CAST(1 AS BIGINT) FROM nodes
          UNION
          SELECT k.sd, k.so, w.layer + 1 FROM walk w
          JOIN known k ON k.dd = w.dataset_id AND k.dobj = w.object_id
        ),
        deep AS (SELECT dataset_id, object_id, max(layer) AS layer FROM walk GROUP BY ALL)
        SELECT {layer_columns} FROM nodes JOIN deep USING (dataset_id, object_id)
        """

    star_layer = (
        "CASE dataset_id WHEN 'part' THEN 1 WHEN 'region' THEN 1 WHEN 'nation' THEN 2"
        " WHEN 'lineitem' THEN 5 WHEN 'orders' THEN 4 ELSE 3 END"
    )
    star = f"SELECT CAST({star_layer} AS BIGINT) AS {layer_columns} FROM ({corpora.STAR_NODES_SQL}) AS nodes"
    script_layers = f"""
        WITH RECURSIVE nodes AS ({_select(f"k, 'ds' || ds AS dataset_id, 'v' || k AS object_id, {_KIND} AS object_type", _OK)}),
        edges AS ({_EDGES_SQL}),
        walk(k, layer) AS (
          SELECT k, CAST(1 AS BIGINT) FROM nodes
          UNION
          SELECT e.src_k, w.layer + 1 FROM walk w JOIN edges e ON e.dep_k = w.k
        ),
        deep AS (SELECT k, max(layer) AS layer FROM walk GROUP BY k)
        SELECT {layer_columns}, CAST(k AS STRING) AS script_id FROM nodes JOIN deep USING (k)
    """
    turns = corpora.TURN_NODES_SQL
    return {
        "trim_edges": f"SELECT script_id, trim(body, {_WHITE_SPACE}) AS body FROM {_FREE}",
        "dedent": _select(f"{_ID}, {_QUERY_TEXT} AS body", source=_NO_PAD),
        "strip_comments": "SELECT script_id, regexp_replace(body, "
        f"{_COMMENTS}, '\\1\\2', 'g') AS body FROM {_FREE}",
        "clean_body": _select(
            f"{_ID}, trim(regexp_replace({_QUERY_TEXT}, {_COMMENTS}, '\\1\\2', 'g'),"
            f" {_WHITE_SPACE}) AS body",
            source=_NO_PAD,
        ),
        "placeholder_substitution": f"""
            SELECT script_id, CASE WHEN project != '' THEN
              replace(body, '$' || chr(123) || 'project' || chr(125), project) ELSE body END AS body
            FROM ({corpora.PLACEHOLDERS_SQL}) AS p""",
        "load_table": "SELECT CAST(doc_id AS STRING) AS script_id, text AS sql FROM documents",
        "classify": _select(f"{_ID}, {_KIND} AS kind"),
        "load_scripts": "SELECT CAST(n_nationkey AS STRING) AS folder, 'CREATE VIEW ds.n' || n_nationkey"
        " || ' AS SELECT ' || chr(39) || n_name || chr(39) || chr(10) AS sql FROM nation",
        "rejects": _select(_REJECTED, "shape IN (6, 10)"),
        "lineage_rejects": _select(_REJECTED, "shape IN (6, 10)"),
        "order_rejects": _select(_REJECTED, "shape IN (6, 10)"),
        "followed_rejects": _select(_REJECTED, "shape IN (6, 10)"),
        "followed_objects": _select(
            f"{_ID}, {_KIND} AS kind, 'ds' || ds AS dataset_id, 'v' || k AS object_id", _OK
        ),
        "repeated_scripts": "SELECT CAST(conv_id AS STRING) AS script_id, count(*) AS entries"
        " FROM conversations GROUP BY conv_id HAVING count(*) > 1",
        "creation_stages_again": f"""
            SELECT reference_id, layer, CASE WHEN layer % 2 = 0 THEN 2 ELSE 1 END AS run
            FROM ({script_layers}) AS layered""",
        "blank_ids": "SELECT concat('d', c_custkey::VARCHAR) AS dataset_id, CASE c_custkey % 4"
        " WHEN 0 THEN chr(9) WHEN 1 THEN ' ' || chr(10) ELSE chr(12288) END AS object_id"
        " FROM customer WHERE c_custkey % 4 <> 2",
        "huge_intervals": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0"
        " THEN 'INTERVAL 9223372036854775807 HOUR' ELSE '0-0 0 3:0:0' END AS normalized FROM orders",
        "rejects_routine_family": _select(
            f"{_ID}, CASE WHEN {_VIEWS} THEN 'not a routine' ELSE {_REASON} END AS reason,"
            # shape 0 begins with a comment line
            f" CAST(CASE WHEN shape = 0 THEN length('-- view ' || k) + 1 WHEN {_VIEWS} THEN 0"
            f" ELSE {_OFFSET} END AS BIGINT) AS \"offset\","
            f" CAST(CASE WHEN shape = 0 OR {_SECOND_LINE} THEN 2 ELSE 1 END AS BIGINT) AS line,"
            f" CAST(CASE WHEN {_VIEWS} THEN 1 WHEN {_SECOND_LINE} THEN 3 ELSE {_OFFSET} + 1 END AS BIGINT) AS \"column\"",
            f"shape IN (6, 10) OR {_VIEWS}",
        ),
        "accepted_views": _select(
            f"{_ID}, {_KIND} AS kind, {_MATERIALIZED} AS is_materialized", _VIEWS
        ),
        "free_text_rejects": f"SELECT script_id FROM {_FREE}",
        "qualified_names": _select(
            f"{_ID}, CASE WHEN {_PROJ} THEN 'proj' END AS project, 'ds' || ds AS dataset_id,"
            " 'v' || k AS object_id",
            _OK,
        ),
        "object_ids": _select(
            f"{_ID}, 'ds' || ds || '.v' || k AS reference_id,"
            f" 'projects/' || CASE WHEN {_PROJ} THEN 'proj' ELSE 'any' END || '/datasets/ds' || ds"
            f" || CASE WHEN {_VIEWS} THEN '/tables/v' ELSE '/routines/v' END || k AS resource_id,"
            f" CASE WHEN {_VIEWS} THEN 'VIEW' ELSE 'ROUTINE' END AS resource_type",
            _OK,
        ),
        "language": _select(
            f"{_ID}, CASE WHEN shape IN (9, 12) THEN 'PYTHON' WHEN shape = 11 THEN 'JAVASCRIPT'"
            " ELSE 'SQL' END AS language",
            _ROUTINES,
        ),
        "body_span": _select(f"{_ID}, {_case(_BODY)} AS body", _OK),
        "partitioning": _select(
            f"{_ID}, CASE WHEN {_MATERIALIZED} THEN 'DAY' END AS partitioning_type,"
            " CASE shape WHEN 1 THEN 'created' WHEN 8 THEN 'day' END AS partitioning_field",
            _VIEWS,
        ),
        "clustering": _list_rows(
            "position, name",
            [
                ("shape = 1", "CAST(1 AS BIGINT)", "'c' || m3"),
                ("shape = 1", "CAST(2 AS BIGINT)", "'key'"),
                ("shape = 8", "CAST(1 AS BIGINT)", "'a'"),
            ],
        ),
        "view_settings": _select(
            f"{_ID}, CASE shape WHEN 1 THEN true WHEN 8 THEN false END AS enable_refresh,"
            " CASE WHEN shape = 1 THEN false END AS allow_non_incremental_definition,"
            " CASE WHEN shape = 1 THEN CAST(m90 * 60000 AS BIGINT) END AS refresh_interval_ms,"
            " CASE shape WHEN 1 THEN '0-0 0 ' || (m200 // 60) || ':' || (m200 % 60) || ':0'"
            " WHEN 8 THEN '0-0 0 ' || m3 || ':' || m90 || ':0' END AS max_staleness,"
            " CASE WHEN shape = 1 THEN 'projects/p/key' || m3 END AS kms_key_name",
            _VIEWS,
        ),
        "text_options": _select(
            f"{_ID}, CASE shape WHEN 0 THEN 'it''s view ' || k WHEN 1 THEN 'mat ' || k"
            " WHEN 2 THEN 'fn ' || k END AS description,"
            " CASE WHEN shape = 0 THEN 'v ' || k END AS friendly_name,"
            " CASE WHEN shape = 11 THEN 'DETERMINISTIC' END AS determinism_level,"
            " CASE WHEN shape = 11 THEN 'MASKING_' || m3 END AS data_governance_type",
            _OK,
        ),
        "interval_values": """
            SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              CASE l_linenumber % 6
                WHEN 0 THEN '0-0 0 ' || l_orderkey || ':0:0'
                WHEN 1 THEN '0-0 0 ' || (l_orderkey // 60) || ':' || (l_orderkey % 60) || ':0'
                WHEN 2 THEN '0-0 0 ' || (l_orderkey // 3600) || ':' || (l_orderkey % 3600 // 60)
                  || ':' || (l_orderkey % 60)
                WHEN 3 THEN '0-0 ' || l_orderkey || ' 0:0:0'
                WHEN 4 THEN '0-' || l_orderkey || ' 0 0:0:0'
                ELSE l_orderkey || '-0 0 0:0:0' END AS interval_value
            FROM lineitem""",
        "return_types": _select(
            f"{_ID}, CASE WHEN shape IN (2, 4, 11) THEN 'FLOAT64' WHEN shape = 9 THEN 'STRING'"
            " WHEN shape = 13 THEN 'BYTES' END AS return_type,"
            " CASE WHEN shape = 3 THEN 'TABLE<id INT64, name STRING>' END AS return_table_type",
            _ROUTINES,
        ),
        "routine_arguments": _arguments_sql(),
        "argument_types": _types_sql(),
        "view_columns": _list_rows(
            "position, name, type, mode, description",
            [
                ("shape = 0", "CAST(1 AS BIGINT)", "'key'", "'STRING'", "'NULLABLE'",
                 "'key, of ' || k"),
                ("shape = 0", "CAST(2 AS BIGINT)", "'total'", "'STRING'", "'NULLABLE'",
                 "CAST(NULL AS VARCHAR)"),
            ],
        ),
        "options_table": _options_sql(),
        "list_options": _list_rows(
            "name, position, value",
            [
                ("shape = 9", "'imported_libraries'", "CAST(1 AS BIGINT)",
                 "'gs://b/l' || m3 || '.py'"),
                ("shape = 9", "'packages'", "CAST(1 AS BIGINT)", "'numpy==1.' || m3"),
                ("shape = 9", "'packages'", "CAST(2 AS BIGINT)", "'pandas'"),
                ("shape = 11", "'imported_libraries'", "CAST(1 AS BIGINT)", "'gs://b/one.js'"),
                ("shape = 12", "'jar_uris'", "CAST(1 AS BIGINT)", "'gs://b/a.jar'"),
                ("shape = 12", "'jar_uris'", "CAST(2 AS BIGINT)", "'gs://b/b' || m3 || '.jar'"),
            ],
        ),
        "pair_options": _list_rows(
            "name, key, value",
            [
                ("shape = 0", "'labels'", "'band'", "'b' || m3"),
                ("shape = 0", "'labels'", "'src'", "'o'"),
                ("shape = 12", "'properties'", "'spark.x'", "CAST(m3 AS STRING)"),
                ("shape = 13", "'user_defined_context'", "'mode'", "'m' || m3"),
            ],
        ),
        "option_groups": _select(
            f"{_ID}, CASE WHEN shape = 13 THEN 'https://e/' || k END AS endpoint,"
            " CASE WHEN shape = 13 THEN CAST(m90 AS STRING) END AS remote_rows,"
            " CASE WHEN shape = 12 THEN '2.' || m3 END AS spark_version,"
            " CASE WHEN shape = 12 THEN 'gs://b/main' || k || '.py' END AS main_file_uri,"
            " CASE WHEN shape = 9 THEN 'main' || m3 END AS entry_point,"
            " CASE WHEN shape = 9 THEN 'python-3.11' END AS external_version,"
            " CASE WHEN shape = 9 THEN CAST(m90 AS STRING) END AS external_rows,"
            " CASE WHEN shape = 9 THEN '1' END AS container_cpu,"
            " shape != 13 AS no_remote, shape != 12 AS no_spark, shape != 9 AS no_python,"
            " shape != 9 AS no_external",
            _ROUTINES,
        ),
        "connections": _select(
            f"{_ID}, CASE WHEN shape = 13 THEN 'proj.us.remote' || m3 END AS remote_connection,"
            " CASE WHEN shape = 12 THEN 'proj.us.spark' || m3 END AS spark_connection,"
            " CASE WHEN shape = 9 THEN 'proj.us.conn' || m3 END AS external_connection",
            _ROUTINES,
        ),
        "body_tokens": _tokens_sql(f"({corpora.BODIES_SQL}) AS bodies"),
        "free_text_tokens": _tokens_sql(_FREE),
        "free_text_names": _free_names_sql(_FREE),
        "mixed_names": _free_names_sql(f"({corpora.MIXED_BODIES_SQL}) AS mixed"),
        "mixed_blocks": _select(f"{_ID}, {corpora.MIXED_BLOCK} AS body"),
        "mixed_arguments": _union(
            *[
                _select(
                    f"{_ID}, CAST({i + 1} AS BIGINT) AS position, 'a{i}' AS name,"
                    f" nullif(trim({corpora.argument_mode(i)}), '') AS mode,"
                    f" {corpora.argument_type(i, False)} AS data_type",
                    f"{corpora.ARGUMENT_COUNT} > {i}",
                )
                for i in range(3)
            ]
        ),
        "script_names": f"SELECT script_id, position, dataset_id, object_id, object_type,"
        f" has_project, metadata FROM ({_NAMES_SQL}) AS x",
        "references": _REFERENCES_SQL,
        "foreign_datasets": _FOREIGN_SQL,
        "homeless_foreign_datasets": _union(
            *[
                f"SELECT DISTINCT {_ID}, {dataset} AS dataset_id FROM {_N}"
                for dataset in ("'dsx'", "'dsu'")
            ],
            f"(SELECT {_ID}, 'ds' || hd AS dataset_id FROM {_N}"
            f" UNION SELECT {_ID}, 'ds' || td FROM {_N})",
        ),
        "qualified_bodies": _union(
            _rewritten("'env-proj'", _ROUTINES),
            _select(f"{_ID}, {_view_bodies()} AS body", _VIEWS),
        ),
        "inferred_project_bodies": _union(
            _rewritten("'proj'", _PROJ),
            _select(f"{_ID}, {_own_bodies()} AS body", f"{_ROUTINES} AND NOT {_PROJ}"),
        ),
        "layers_chain": f"""
            SELECT {layer_columns} FROM (
              SELECT CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT)
                AS layer, 'shop' AS dataset_id, 'o' || o_orderkey AS object_id,
                'VIEW' AS object_type
              FROM orders) AS ranked""",
        "layers_turns": deepest(turns, corpora.TURN_EDGES_SQL),
        "layers_star": star,
        "layers_star_salted": star,
        "layers_hot": f"""
            SELECT {layer_columns} FROM (
              SELECT 1 + row_number() OVER (PARTITION BY l_orderkey, l_linenumber - place ORDER BY l_linenumber)
                AS layer, 'o' || l_orderkey AS dataset_id, 'l' || l_linenumber AS object_id, 'VIEW' AS object_type
              FROM (SELECT l_orderkey, l_linenumber,
                           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place
                    FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) AS lines) AS placed
              UNION ALL SELECT 1, 'hub', 'hub', 'VIEW' FROM region WHERE r_regionkey = 0) AS layered""",
        "layer_depth": f"""
            SELECT CAST(max(layer) AS BIGINT) AS depth
            FROM ({deepest(turns, corpora.TURN_EDGES_SQL)}) AS layered""",
        "duplicate_nodes": """
            SELECT 'lineitem' AS dataset_id, l_orderkey || '-' || l_linenumber AS object_id,
                   count(*) AS entries
            FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
        "managed_edges": f"SELECT src, dep FROM ({_EDGES_SQL}) AS e",
        "indegrees": f"""
            SELECT 'ds' || n.ds AS dataset_id, 'v' || n.k AS object_id,
                   count(e.src) AS indegree
            FROM (SELECT * FROM {_N} WHERE {_OK}) AS n
            LEFT JOIN ({_EDGES_SQL}) AS e ON e.src_k = n.k GROUP BY ALL""",
        "cycle_members": f"""
            SELECT dataset_id || '.' || object_id AS reference_id FROM ({turns}) AS nodes
            WHERE CAST(substr(object_id, 2) AS BIGINT) >= 2 AND dataset_id IN (
              SELECT dataset_id FROM ({turns}) AS later WHERE object_id = 't3')""",
        "creation_layers": f"SELECT * EXCLUDE (script_id) FROM ({script_layers}) AS layered",
        "creation_stages": f"""
            SELECT reference_id, script_id, object_type AS kind, layer
            FROM ({script_layers}) AS layered""",
        "access_grants": f"""
            SELECT DISTINCT dataset_id AS granting_dataset,
              CASE WHEN {_PROJ} THEN 'proj' END AS project, 'ds' || ds AS dataset_id,
              'v' || k AS object_id,
              CASE WHEN {_VIEWS} THEN 'VIEW' ELSE 'ROUTINE' END AS resource_type
            FROM ({_NAMES_SQL}) AS x WHERE x.dataset_id != 'ds' || ds""",
    }


def _view_bodies() -> str:
    plain = _QUERY_TEXT.replace("CAST(pad AS STRING)", "''")
    cleaned = f"trim({plain}, {corpora.NL})"
    union = f"'(SELECT 1 AS x) UNION ALL (' || {corpora.NL} || {_QUERY_TEXT} || ')'"
    return _case({0: cleaned, 1: cleaned, 7: union, 8: cleaned})


def _own_bodies() -> str:
    """Routine bodies as written, cleaned: no project is known for these."""
    plain = _QUERY_TEXT.replace("CAST(pad AS STRING)", "''")
    return _case(
        {
            3: f"trim({plain}, {corpora.NL})",
            4: f"'(' || {corpora.NL} || {_QUERY_TEXT} || ')'",
            5: f"trim({text(corpora._CALLS)}, ' ')",
            11: text("return \"a\" + 'b';"),
            13: "''",
        }
    )


def _arguments_sql() -> str:
    def row(where, position, name, data_type, kind="FIXED_TYPE", mode=None, aggregate="NULL"):
        return (
            where,
            f"CAST({position} AS BIGINT)",
            f"'{name}'",
            "CAST(NULL AS VARCHAR)" if data_type is None else f"'{data_type}'",
            f"'{kind}'",
            "CAST(NULL AS VARCHAR)" if mode is None else f"'{mode}'",
            f"CAST({aggregate} AS BOOLEAN)",
        )

    return _list_rows(
        "position, name, data_type, argument_kind, mode, is_aggregate",
        [
            row("shape = 2", 1, "x", "INT64"),
            row("shape = 2", 2, "y", "ARRAY<STRUCT<a INT64, b NUMERIC>>"),
            row("shape = 2", 3, "z", None, "ANY_TYPE"),
            row("shape = 3", 1, "n", "INT64"),
            row("shape = 3", 2, "src", "TABLE<plate STRING, at TIMESTAMP>"),
            row("shape = 4", 1, "x", "FLOAT64", aggregate="true"),
            row("shape = 4", 2, "w", "FLOAT64", aggregate="false"),
            row("shape = 5", 1, "a", "INT64", mode="IN"),
            row("shape = 5", 2, "b", "STRING", mode="OUT"),
            row("shape = 5", 3, "c", "BOOL", mode="INOUT"),
            row("shape = 9", 1, "x", "FLOAT64"),
            row("shape = 11", 1, "x", "FLOAT64", aggregate="true"),
            row("shape = 13", 1, "x", "BYTES"),
        ],
    )


def _types_sql() -> str:
    def kind(name: str) -> str:
        return f'{{"typeKind":"{name}"}}'

    def fields(*pairs: tuple[str, str]) -> str:
        return "[" + ",".join(f'{{"name":"{n}","type":{kind(t)}}}' for n, t in pairs) + "]"

    pairs = fields(("a", "INT64"), ("b", "NUMERIC"))
    struct = f'{{"typeKind":"STRUCT","structType":{{"fields":{pairs}}}}}'
    nested = f'{{"typeKind":"ARRAY","arrayElementType":{struct}}}'
    plates = fields(("plate", "STRING"), ("at", "TIMESTAMP"))
    returned = fields(("id", "INT64"), ("name", "STRING"))
    typed = '"type":"STRING","mode":"NULLABLE"'
    schema = (
        f"""'[{{"name":"key",{typed},"description":"key, of ' || k || '"}},"""
        f"""{{"name":"total",{typed}}}]'"""
    )
    trees = [
        (2, "x", kind("INT64")), (2, "y", nested), (2, "(return)", kind("FLOAT64")),
        (3, "n", kind("INT64")),
        (3, "src", f'{{"tableType":{{"columns":{plates}}},"typeKind":"TABLE"}}'),
        (3, "(table)", f'{{"columns":{returned}}}'),
        (4, "x", kind("FLOAT64")), (4, "w", kind("FLOAT64")), (4, "(return)", kind("FLOAT64")),
        (5, "a", kind("INT64")), (5, "b", kind("STRING")), (5, "c", kind("BOOL")),
        (9, "x", kind("FLOAT64")), (9, "(return)", kind("STRING")),
        (11, "x", kind("FLOAT64")), (11, "(return)", kind("FLOAT64")),
        (13, "x", kind("BYTES")), (13, "(return)", kind("BYTES")),
    ]
    rows = [(f"shape = {shape}", f"'{place}'", f"'{tree}'") for shape, place, tree in trees]
    return _list_rows("place, tree", [*rows, ("shape = 0", "'(schema)'", schema)])


def _options_sql() -> str:
    written = {
        0: {
            "description": "'it''s view ' || k",
            "friendly_name": "'v ' || k",
            "labels": """'[("band", "b' || m3 || '"), ("src", ''o'')]'""",
        },
        1: {
            "enable_refresh": "'TRUE'",
            "allow_non_incremental_definition": "'false'",
            "refresh_interval_minutes": "CAST(m90 AS STRING)",
            "max_staleness": "'INTERVAL ' || m200 || ' MINUTE'",
            "kms_key_name": "'projects/p/key' || m3",
            "description": "'mat ' || k",
        },
        2: {"description": "'fn ' || k"},
        8: {
            "max_staleness": """'INTERVAL "' || m3 || ':' || m90 || ':0" HOUR TO SECOND'""",
            "enable_refresh": "'FALSE'",
        },
        9: {
            "max_batching_rows": "CAST(m90 AS STRING)",
            "entry_point": "'main' || m3",
            "runtime_version": "'python-3.11'",
            "packages": """'[''numpy==1.' || m3 || ''', "pandas"]'""",
            "library": "'[''gs://b/l' || m3 || '.py'']'",
            "container_cpu": "'1'",
        },
        11: {"library": "'gs://b/one.js'", "determinism_level": "'deterministic'",
             "data_governance_type": "'Masking_' || m3"},
        12: {
            "engine": "'SPARK'",
            "runtime_version": "'2.' || m3",
            "main_file_uri": "'gs://b/main' || k || '.py'",
            "jar_uris": "'[''gs://b/a.jar'', ''gs://b/b' || m3 || '.jar'']'",
            "properties": """'[("spark.x", "' || m3 || '")]'""",
        },
        13: {
            "endpoint": "'https://e/' || k",
            "user_defined_context": """'[("mode", "m' || m3 || '")]'""",
            "max_batching_rows": "CAST(m90 AS STRING)",
        },
    }
    return _list_rows(
        "name, value",
        [
            (f"shape = {shape}", f"'{name}'", value)
            for shape, options in written.items()
            for name, value in options.items()
        ],
    )
