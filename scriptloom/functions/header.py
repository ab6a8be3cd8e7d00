"""The header of a CREATE script: what stands before the body.

A header is cut into its top-level bracket groups, and each group into its items, by one fold over
its tokens. What is left at the top level (the outline, with ``()`` and ``<>`` in place of the
groups) is short and regular, so plain patterns read every clause from it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptloom.functions import lexis
from scriptloom.functions.binding import let
from scriptloom.functions.text import trim_edges
from scriptloom.functions.values import bare_name, normalize_type, null_if_empty, type_json, unescape

# The fold writes items to one string: appending there moves bytes, where an array would be built
# anew from its elements each time. A record ends with _RECORD, its fields are parted by _FIELD; the
# text comes last and escapes only the first.
_RECORD, _ESCAPE, _FIELD = "\x01", "\x02", "\x03"

# --- fixed values: words of the CREATE statements ---------------------------------------------

KINDS = {
    "VIEW": "VIEW",
    "MATERIALIZED VIEW": "MATERIALIZED_VIEW",
    "FUNCTION": "SCALAR_FUNCTION",
    "TABLE FUNCTION": "TABLE_VALUED_FUNCTION",
    "AGGREGATE FUNCTION": "AGGREGATE_FUNCTION",
    "PROCEDURE": "PROCEDURE",
}
VIEW_KINDS = ("VIEW", "MATERIALIZED_VIEW")
# Words that start a clause, so a name cannot run into them.
CLAUSE_WORDS = (
    "LANGUAGE",
    "OPTIONS",
    "AS",
    "REMOTE",
    "WITH",
    "BEGIN",
    "END",
    "RETURNS",
    "PARTITION",
    "CLUSTER",
)

_GAP = rf"(?:(?U:\s)|{lexis.HEADER_COMMENT})*+"
_END = lexis.WORD_END
_NAME_PART = rf"(?:`[^`]*+`|(?!(?i:{'|'.join(CLAUSE_WORDS)}){_END}){lexis.WORD})"
_NAME = rf"{_NAME_PART}(?:{_GAP}\.{_GAP}{_NAME_PART})*+"
_CREATE = rf"(?i)\A{_GAP}CREATE{_END}{_GAP}(?:OR{_END}{_GAP}REPLACE{_END}{_GAP})?"
_KIND = (
    rf"(MATERIALIZED{_END}{_GAP}VIEW|VIEW|TABLE{_END}{_GAP}FUNCTION"
    rf"|AGGREGATE{_END}{_GAP}FUNCTION|FUNCTION|PROCEDURE){_END}"
)
LEADING_GAP = rf"\A{_GAP}"
CREATE = _CREATE
CREATE_KIND = rf"{_CREATE}(TEMPORARY{_END}|TEMP{_END})?{_GAP}{_KIND}"
CREATE_NAME = (
    rf"{CREATE_KIND}{_GAP}(?:IF{_END}{_GAP}NOT{_END}{_GAP}EXISTS{_END}{_GAP})?"
    rf"(?!IF{_END}{_GAP}NOT{_END})({_NAME})(?:{_GAP}\.)?"
)

_TOKEN = (
    rf"({lexis.SINGLE_CLOSED}|`[^`]*+`|{lexis.HEADER_COMMENT}|[()<>\[\],;]"
    rf"|(?:[^'\"`()<>\[\],;/-]|-(?!-)|/(?!\*))++|[\s\S])"
)

# The same tokens for headers without comments whose brackets are closed and at most NESTED deep: the
# top level as runs and groups, and the items of a group. What these do not fit is folded.
NESTED = 8
_OPEN, _CLOSE = r"[(<\[]", r"[)>\]]"
_LITERAL = rf"{lexis.SINGLE_CLOSED}|`[^`]*+`"
_DASH = r"-(?!-)|/(?!\*)"
_RUN = rf"(?:[^'\"`()<>\[\],;/-]++|{_DASH})++"
_INNER = lexis.nested(_OPEN, rf"[^'\"`()<>\[\]/-]++|{_LITERAL}|{_DASH}", _CLOSE, NESTED)
_TOP = rf"\A(?:{_RUN}|{_LITERAL}|,|{_OPEN}{_INNER}{_CLOSE})*+(?:;|\z)"
_GROUP = rf"\G((?:{_RUN}|{_LITERAL}|,)*+)({_OPEN})({_INNER})({_CLOSE})"
_ITEM_PIECE = rf"[^'\"`()<>\[\],/-]++|{_LITERAL}|{_DASH}|{_OPEN}{_INNER}{_CLOSE}"
_ITEM = rf"\G((?:{_ITEM_PIECE})*+(?=,)|(?:{_ITEM_PIECE})++\z),?+"
_LEAD = rf"({lexis.WORD})\s*+\z"

# Clauses as the outline shows them.
_WORD = lexis.WORD
_PLAIN_NAME = rf"{_NAME_PART}(?:\s*\.\s*{_NAME_PART})*+"
_RETURNS = rf"RETURNS\s+({_WORD})\s*+(<>)?+\s*+(?:\(\))?+\s*+"
_CLAUSE = (
    rf"(?:LANGUAGE\s+[^\s()<>;]++|(?:REMOTE\s+)?WITH\s+CONNECTION\s+{_PLAIN_NAME}"
    rf"|OPTIONS\s*+\(\))\s*+"
)
ROUTINE_OUTLINE = rf"(?i)\A\s*+(?:\(\)\s*+)?+(?:{_RETURNS})?+(?:{_CLAUSE})*+"
_COLUMN = rf"(?:`[^`]*+`|{_WORD})"
VIEW_OUTLINE = (
    rf"(?i)\A\s*+(?:\(\)\s*+)?+(?:PARTITION\s+BY\s+({_COLUMN})\s*+(\(\))?+\s*+)?+"
    rf"(?:CLUSTER\s+BY\s+({_COLUMN}(?:\s*+,\s*+{_COLUMN})*+)\s*+)?+(?:OPTIONS\s*+\(\)\s*+)?+"
)

# Items of the lists.
_TYPE = rf"(?:(?i:ANY)\s++(?i:TYPE)|{_WORD}(?:\s*\.\s*{_WORD})*+\s*+(?:\([^()]*+\)|<[\s\S]*>)?+)?+"
ARGUMENT = (
    rf"\A\s*+(?:(?i:(INOUT|IN|OUT)){_END}\s++)?+({_COLUMN})\s*+({_TYPE})\s*+"
    rf"((?i:NOT\s+AGGREGATE){_END})?+\s*+\z"
)
_VALUE = (
    rf"(?:{lexis.SINGLE_CLOSED}|\[[\s\S]*\]|`[^`]*+`|(?i:INTERVAL){_END}[^\[\]]*+"
    rf"|[\p{{Nd}}.]++|{_WORD}|\([\s\S]*\))"
)
OPTION = rf"\A\s*+({_COLUMN})\s*+=?+\s*+({_VALUE})\s*+\z"
COLUMN_ITEM = rf"(?i)\A\s*+({_COLUMN})\s*+(?:OPTIONS\s*+\(([\s\S]*)\))?+\s*+\z"


def header_text(script: Column) -> Column:
    return F.regexp_extract(script, lexis.HEADER, 0)


def object_kind(header: Column) -> Column:
    """One of the six kinds, or null."""
    words = F.upper(F.regexp_extract(header, CREATE_KIND, 2))
    words = F.trim(F.regexp_replace(words, rf"(?:\s|{lexis.HEADER_COMMENT})++", " "))
    return F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])[words]


def name_parts(name: Column) -> Column:
    """``project``, ``dataset_id`` and ``object_id`` of a name of one, two, three or more parts."""
    plain = F.regexp_replace(name, rf"(`[^`]*+`)|(?:\s|{lexis.HEADER_COMMENT})++", "$1")
    parts = F.transform(
        F.split(F.replace(plain, F.lit("`"), F.lit("")), r"\."), lambda p: F.trim(p)
    )
    size = F.size(parts)
    return F.struct(
        F.when(size >= 3, null_if_empty(F.get(parts, F.lit(0)))).alias("project"),
        null_if_empty(
            F.when(size >= 3, F.get(parts, F.lit(1))).when(size == 2, F.get(parts, F.lit(0)))
        ).alias("dataset_id"),
        F.get(parts, size - 1).alias("object_id"),
    )


def reference_id(dataset: Column, obj: Column) -> Column:
    """``dataset.object``, or null where either is empty."""
    return F.when((dataset != "") & (obj != ""), F.concat_ws(".", dataset, obj))


def resource_id(kind: Column, project: Column, dataset: Column, obj: Column) -> Column:
    """Full path of an object; a missing project or dataset reads ``any``."""
    folder = F.when(kind.isin(*VIEW_KINDS), "tables").otherwise("routines")
    known = [F.coalesce(null_if_empty(x), F.lit("any")) for x in (project, dataset)]
    return F.concat(
        F.lit("projects/"), known[0], F.lit("/datasets/"), known[1], F.lit("/"), folder,
        F.lit("/"), obj,
    )


def resource_type(object_type: Column) -> Column:
    return F.when(
        F.upper(object_type).isin("VIEW", "MATERIALIZED_VIEW", "TABLE"), "VIEW"
    ).otherwise("ROUTINE")


def outline(clauses: Column) -> Column:
    """The outline of the clauses after the name, and the items of their bracket groups.

    Gives ``struct<depth, outline, items, mark>``; a depth other than 0 means unbalanced brackets, and
    then ``mark`` counts the characters before the outermost one that is not closed or not open.
    ``lead`` of an item is the word before its group, ``open`` the bracket that opens the group.

    Where every group but one at the very start has its word right before it, the groups are cut out by
    patterns; all other clauses are folded token by token.
    """

    def cut(text: Column, pieces: Column) -> Column:
        return let(_led_groups(pieces), lambda groups: _cut_or_folded(text, pieces, groups))

    def outlined(text: Column) -> Column:
        return let(_top(text), lambda top: let(_pieces(text, top), lambda pieces: cut(text, pieces)))

    return let(clauses, outlined)


def outline_columns(clauses: Column) -> list[tuple[str, Column]]:
    """``outline`` as column ``_outlined``, with its steps in columns before it: so they are compiled, and
    results are not copied from step to step."""
    text, top, pieces, groups = (F.col(c) for c in ("_clauses", "_top", "_pieces", "_groups"))
    return [
        ("_clauses", clauses),
        ("_top", _top(text)),
        ("_pieces", _pieces(text, top)),
        ("_groups", _led_groups(pieces)),
        ("_outlined", _cut_or_folded(text, pieces, groups)),
    ]


def _top(text: Column) -> Column:
    """The clauses up to a semicolon; empty or null where only the fold can read them."""
    return F.when(~text.rlike(f"[{_RECORD}{_FIELD}]"), F.regexp_extract(text, _TOP, 0))


def _pieces(text: Column, top: Column) -> Column:
    """The groups with the text before each, in fields; null where they are to be folded."""
    marked = F.regexp_replace(top, _GROUP, f"$1{_FIELD}$2{_FIELD}$3{_FIELD}$4{_RECORD}")
    found = F.transform(F.split(marked, _RECORD), lambda piece: F.split(piece, _FIELD))
    return F.when((top != "") | (text == ""), found)


def _cut_or_folded(text: Column, pieces: Column, groups: Column) -> Column:
    unled = F.exists(groups, lambda g: (g["lead"] == "") & ((g["at"] > 0) | (trim_edges(g["before"]) != "")))
    return F.when(~unled, _cut_outline(pieces, groups)).otherwise(_folded_outline(text))


def _led_groups(pieces: Column) -> Column:
    """The groups with the text before each and its last word; behind the last group stands one field alone."""
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p, i: F.struct(
            i.alias("at"),
            F.get(p, F.lit(0)).alias("before"),
            F.upper(F.regexp_extract(F.get(p, F.lit(0)), _LEAD, 1)).alias("lead"),
            F.get(p, F.lit(1)).alias("open"),
            F.get(p, F.lit(2)).alias("inner"),
        ),
    )


def _cut_outline(pieces: Column, groups: Column) -> Column:
    shown = F.transform(
        pieces, lambda p: F.concat_ws("", F.get(p, F.lit(0)), F.get(p, F.lit(1)), F.get(p, F.lit(3)))
    )
    items = F.transform(
        groups,
        lambda group, i: F.transform(
            F.regexp_extract_all(trim_edges(group["inner"]), F.lit(_ITEM), F.lit(1)),
            lambda item: F.struct(
                (i + 1).alias("grp"),
                group["lead"].alias("lead"),
                group["open"].alias("open"),
                trim_edges(item).alias("text"),
            ),
        ),
    )
    return F.struct(
        F.lit(0).alias("depth"),
        _blanks_as_one(F.array_join(shown, "")).alias("outline"),
        F.flatten(items).alias("items"),
        F.lit(0).alias("mark"),
    )


def _blanks_as_one(text: Column) -> Column:
    """Each run of white space as one blank; single blanks are left as they are."""
    return F.regexp_replace(text, r"\s\s++|[^\S ]", " ")


def _folded_outline(clauses: Column) -> Column:
    tokens = F.regexp_extract_all(clauses, F.lit(_TOKEN), F.lit(1))
    start = F.struct(
        F.lit(0).alias("depth"),
        F.lit(0).alias("grp"),
        F.lit("").alias("outline"),
        F.lit("").alias("lead"),
        F.lit("").alias("open"),
        F.lit("").alias("item"),
        F.lit(False).alias("done"),
        F.lit("").alias("items"),
        F.lit(0).alias("at"),
        F.lit(0).alias("mark"),
    )
    fields = ("depth", "grp", "outline", "lead", "open", "item", "done", "items", "at", "mark")

    def step(acc: Column, token: Column) -> Column:
        depth = acc["depth"]
        text = F.when(token.startswith("--") | token.startswith("/*"), " ").otherwise(token)
        opens = token.isin("(", "<", "[")
        closes = token.isin(")", ">", "]")
        with_item = F.concat(
            acc["items"],
            F.concat_ws(
                _FIELD, acc["grp"].cast("string"), acc["lead"], acc["open"], _escaped(trim_edges(acc["item"]))
            ),
            F.lit(_RECORD),
        )
        lead = F.upper(F.regexp_extract(token, _LEAD, 1))

        def put(**changes: Column | int | str | bool) -> Column:
            changes["at"] = acc["at"] + F.length(token)
            return F.struct(
                *[
                    (F.lit(v) if not isinstance(v, Column) else v).alias(f)
                    for f, v in ((f, changes.get(f, acc[f])) for f in fields)
                ]
            )

        shown = F.concat(acc["outline"], text)
        return (
            F.when(acc["done"], acc)
            .when(
                depth == 0,
                F.when(
                    opens,
                    put(depth=1, grp=acc["grp"] + 1, outline=shown, open=token, item="", mark=acc["at"]),
                )
                .when(closes, put(depth=-1, outline=shown, done=True, mark=acc["at"]))
                .otherwise(
                    put(
                        outline=shown,
                        lead=F.when(lead != "", lead).otherwise(acc["lead"]),
                        done=token == ";",
                    )
                ),
            )
            .when(opens, put(depth=depth + 1, item=F.concat(acc["item"], text)))
            .when(
                closes,
                F.when(
                    depth == 1,
                    put(
                        depth=0,
                        outline=shown,
                        items=F.when(trim_edges(acc["item"]) != "", with_item).otherwise(acc["items"]),
                    ),
                ).otherwise(put(depth=depth - 1, item=F.concat(acc["item"], text))),
            )
            .when((depth == 1) & (token == ","), put(item="", items=with_item))
            .otherwise(put(item=F.concat(acc["item"], text)))
        )

    return F.aggregate(
        tokens,
        start,
        step,
        lambda acc: F.struct(
            acc["depth"].alias("depth"),
            _blanks_as_one(acc["outline"]).alias("outline"),
            F.transform(
                F.filter(F.split(acc["items"], _RECORD), lambda record: record != ""),
                lambda record: let(F.split(record, _FIELD, 4), _item),
            ).alias("items"),
            acc["mark"].alias("mark"),
        ),
    )


def _escaped(text: Column) -> Column:
    marked = F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPE + "e"))
    return F.replace(marked, F.lit(_RECORD), F.lit(_ESCAPE + "r"))


def _item(fields: Column) -> Column:
    text = F.replace(F.get(fields, F.lit(3)), F.lit(_ESCAPE + "r"), F.lit(_RECORD))
    return F.struct(
        F.get(fields, F.lit(0)).cast("int").alias("grp"),
        F.get(fields, F.lit(1)).alias("lead"),
        F.get(fields, F.lit(2)).alias("open"),
        F.replace(text, F.lit(_ESCAPE + "e"), F.lit(_ESCAPE)).alias("text"),
    )


def items_of(items: Column, lead: str, opener: str = "(") -> Column:
    """Texts of the items in the groups after the word ``lead``."""
    return F.transform(
        F.filter(items, lambda i: (i["lead"] == lead) & (i["open"] == opener)),
        lambda i: i["text"],
    )


def returned_type(outline_text: Column, items: Column) -> Column:
    """Type after RETURNS, as normalised text, or null."""
    base = F.regexp_extract(outline_text, ROUTINE_OUTLINE, 1)
    inner = F.transform(F.filter(items, lambda i: i["open"] == "<"), lambda i: i["text"])
    nested = F.concat(base, F.lit("<"), F.array_join(inner, ","), F.lit(">"))
    return F.when(
        base != "",
        normalize_type(
            F.when(F.regexp_extract(outline_text, ROUTINE_OUTLINE, 2) != "", nested).otherwise(base)
        ),
    )


def _groups(text: Column, pattern: str, count: int) -> Column:
    """The groups of a match as an array; of text that does not match, one element."""
    marked = "\0".join(f"${i + 1}" for i in range(count))
    return F.split(F.regexp_replace(text, pattern, marked), "\0")


def parsed_arguments(items: Column) -> Column:
    return F.transform(items, lambda i: _groups(i, ARGUMENT, 4))


def parsed_columns(items: Column) -> Column:
    return F.transform(items, lambda i: _groups(i, COLUMN_ITEM, 2))


def parsed_options(items: Column) -> Column:
    return F.transform(items, lambda i: _groups(i, OPTION, 2))


def all_parsed(parsed: Column) -> Column:
    return F.forall(parsed, lambda p: F.size(p) > 1)


def argument(parts: Column, kind: Column) -> Column:
    """One argument as ``struct<name, data_type, argument_kind, mode, is_aggregate, data_type_json>``."""
    mode, name, written, not_aggregate = (F.get(parts, F.lit(i)) for i in range(4))
    any_type = written.rlike(r"(?i)\AANY\s+TYPE\z")

    def built(data_type: Column) -> Column:
        return F.struct(
            bare_name(name).alias("name"),
            data_type.alias("data_type"),
            F.when(any_type, "ANY_TYPE").otherwise("FIXED_TYPE").alias("argument_kind"),
            null_if_empty(F.upper(mode)).alias("mode"),
            F.when(not_aggregate != "", False)
            .when(kind == "AGGREGATE_FUNCTION", True)
            .alias("is_aggregate"),
            type_json(data_type).alias("data_type_json"),
        )

    return let(F.when(~any_type, normalize_type(written)), built)


def view_column(parts: Column) -> Column:
    """One view column as ``struct<name, description>``."""
    options = F.get(parts, F.lit(1))
    pair = rf"({_COLUMN})\s*+=?+\s*+({lexis.SINGLE_CLOSED}|\[[^\]]*+\]|[^,'\"\[]++)"
    descriptions = F.filter(
        F.zip_with(
            F.regexp_extract_all(options, F.lit(pair), F.lit(1)),
            F.regexp_extract_all(options, F.lit(pair), F.lit(2)),
            lambda k, v: F.struct(k.alias("key"), v.alias("value")),
        ),
        lambda e: e["key"] == "description",
    )
    last = let(descriptions, lambda found: F.get(found, F.size(found) - 1)["value"])
    return F.struct(
        bare_name(F.get(parts, F.lit(0))).alias("name"),
        null_if_empty(
            let(
                F.when(options != "", last),
                lambda v: F.when(v.rlike(r"\A['\"]"), unescape(v)).otherwise(F.trim(v)),
            )
        ).alias("description"),
    )


def schema_json(columns: Column) -> Column:
    """View columns as JSON fields; a script names no types, so all read as STRING. None: null."""
    fields = F.transform(
        columns,
        lambda c: F.struct(
            c["name"].alias("name"),
            F.lit("STRING").alias("type"),
            F.lit("NULLABLE").alias("mode"),
            c["description"].alias("description"),
        ),
    )
    return F.when(F.size(columns) > 0, F.to_json(fields))
