"""Dataset-qualified names in a script body, each with the role its place gives it.

A body is cut into tokens by one pattern and the tokens are folded once, left to right. The fold
carries a handful of scalars (what the last clause word announced, alias progress, paren depth,
the open EXTRACT) and the names kept so far, so a body of any length costs one pass and nothing of
it leaves its row: no explode, no shuffle, no window over tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptloom.functions import lexis
from scriptloom.functions.binding import let

# --- fixed values: clause words by what they announce -----------------------------------------

RELATION_WORDS = ("FROM", "JOIN")
TABLE_WORDS = ("INTO", "UPDATE", "USING", "MERGE", "DELETE", "TRUNCATE")
CALL_WORDS = ("CALL",)
CLOSING_WORDS = (
    "UNNEST", "WITH", "ON", "WHERE", "GROUP", "ORDER", "LIMIT", "HAVING", "SET", "VALUES",
)
PASSING_WORDS = (
    "TABLE", "LEFT", "RIGHT", "FULL", "INNER", "CROSS", "OUTER", "AS", "BY", "SELECT", "DEFAULT",
    "DECLARE", "BEGIN", "END", "IF", "THEN", "ELSE", "ELSEIF", "LOOP", "WHILE", "DO", "FOR", "IN",
    "WHEN", "AND", "OR", "NOT", "UNION", "INTERSECT", "EXCEPT", "QUALIFY", "WINDOW", "TRUE",
    "FALSE", "NULL", "CASE", "MATCHED", "INSERT",
)
# Words that follow a relation without being its alias.
NO_ALIAS_WORDS = (
    "WHERE", "JOIN", "LEFT", "RIGHT", "FULL", "INNER", "CROSS", "OUTER", "GROUP", "ORDER", "LIMIT",
    "HAVING", "ON", "SET", "VALUES", "UNION", "INTERSECT", "EXCEPT", "QUALIFY", "WINDOW", "BEGIN",
    "END", "LOOP", "WHILE", "FOR", "IF", "WHEN", "ELSE", "THEN", "USING", "MERGE", "CALL",
)
METADATA_SCHEMA = "INFORMATION_SCHEMA"
CLAUSE_WORDS = (
    *RELATION_WORDS, *TABLE_WORDS, *CALL_WORDS, *CLOSING_WORDS, *PASSING_WORDS, "EXTRACT",
)

# Roles: what the place announces.
NOTHING, RELATION, TABLE, CALL = 0, 1, 2, 3
# Alias progress after a relation: no alias pending, name just read, AS read, alias read.
SETTLED, NAMED, AS_READ, ALIASED = 0, 1, 2, 3
# Token classes. The quiet ones change nothing where no alias is pending.
(GAP, SIGN, COMMA, LOOSE_COMMA, W_PASSING, W_AS, QUOTE, OPEN, CLOSE, SEMICOLON, NAME, NAME_CALL,
 NAME_DOT, JOINED, JOINED_CALL, JOINED_DOT, SINGLE_DOT, SINGLE_QUOTED, W_EXTRACT, W_FROM, W_JOIN,
 W_TABLE, W_CALL, W_CLOSING, W_OTHER, IDLE_RUN) = range(26)
LAST_QUIET = QUOTE
TELLING_WORDS = (*RELATION_WORDS, *TABLE_WORDS, *CALL_WORDS, "EXTRACT")
NAME_TOKEN = lexis.name_token(CLAUSE_WORDS, TELLING_WORDS, CLOSING_WORDS)
_RUN = rf"\A{lexis.BARE}{lexis.GAP}[^.]"

# Kept names are appended to a short list that is flushed at this length: appending copies the
# list, so one long list would cost the square of the number of names.
FLUSH = 256

_JOINED = r"\A`[^`.]*+\.[^`]*+`"
_NAME_TYPE = "array<struct<at:int,token:string,role:int,joined:boolean>>"


def body_tokens(body: Column) -> Column:
    """The tokens of a body without the gaps between them."""
    return F.regexp_extract_all(body, F.lit(lexis.BODY_TOKEN), F.lit(1))


def name_tokens(body: Column) -> Column:
    """The tokens that names are looked for in: those of ``body_tokens``, runs in which none is kept as one or none."""
    return F.regexp_extract_all(body, F.lit(NAME_TOKEN), F.lit(1))


def name_pieces(body: Column) -> Column:
    """The same tokens, each with the gap before it: joined together they are the body."""
    return F.regexp_extract_all(body, F.lit(NAME_TOKEN), F.lit(0))


def _token_class(token: Column, word: Column, code: Column) -> Column:
    """The class of a token, given with its upper-case form and the code of its first sign."""
    last = F.right(token, F.lit(1))
    dotted = F.contains(token, F.lit("."))
    bare = code.between(97, 122) | code.between(65, 90) | (code == ord("_"))

    def by_tail(plain: int, call: int, dot: int) -> Column:
        return F.when(last == "(", call).when(last == ".", dot).otherwise(plain)

    single_dot = token.rlike(rf"\A{lexis.FIRST_PART}{lexis.GAP}\.\z")
    named = (
        F.when(~dotted, SINGLE_QUOTED)
        .when(single_dot, SINGLE_DOT)
        .when(token.rlike(_JOINED), by_tail(JOINED, JOINED_CALL, JOINED_DOT))
        .otherwise(by_tail(NAME, NAME_CALL, NAME_DOT))
    )
    in_word = (
        F.when(~word.isin(*CLAUSE_WORDS), F.when(token.rlike(_RUN), IDLE_RUN).otherwise(W_OTHER))
        .when(word == "AS", W_AS)
        .when(word == "FROM", W_FROM)
        .when(word.isin(*PASSING_WORDS), W_PASSING)
        .when(word.isin(*CLOSING_WORDS), W_CLOSING)
        .when(word == "JOIN", W_JOIN)
        .when(word.isin(*TABLE_WORDS), W_TABLE)
        .when(word.isin(*CALL_WORDS), W_CALL)
        .otherwise(W_EXTRACT)
    )
    return (
        F.when(code == ord("("), OPEN)
        .when(code == ord(")"), CLOSE)
        .when(token == ",", COMMA)
        # the dots of a run are further on
        .when(bare, F.when(~dotted, in_word).when(token.rlike(_RUN), IDLE_RUN).otherwise(named))
        .when(token == "", GAP)
        .when(code == ord(";"), SEMICOLON)
        .when((code == ord("'")) | (code == ord('"')), QUOTE)
        .when((code == ord("`")) & (F.length(token) > 1), named)
        .when(last == ",", LOOSE_COMMA)
        .otherwise(SIGN)
    )


def _classed(tokens: Column) -> Column:
    """Tokens as ``struct<at, text, cls>``, with their place from 0 and their class."""
    read = F.transform(
        tokens,
        lambda t, i: F.struct(
            i.alias("at"), t.alias("text"), F.upper(t).alias("word"), F.ascii(t).alias("code")
        ),
    )
    return F.transform(
        read,
        lambda r: F.struct(
            r["at"].alias("at"), r["text"].alias("text"),
            _token_class(r["text"], r["word"], r["code"]).alias("cls"),
        ),
    )


def _starts_clause(token: Column) -> Column:
    """Whether the first part of a name is a bare word that cannot be an alias."""
    return F.upper(F.regexp_extract(token, rf"\A{lexis.BARE}", 0)).isin(*NO_ALIAS_WORDS)


def kept_names(tokens: Column) -> Column:
    """Names of two or more parts that stand where a relation is due, or right before a paren.

    Gives ``array<struct<at, token, role, joined>>`` in the order of the body; ``at`` counts tokens
    from 0.
    """
    start = {
        "role": F.lit(NOTHING),
        "alias": F.lit(SETTLED),
        "extract": F.lit(False),
        "depth": F.lit(0),
        "extract_depth": F.lit(0),
        "recent": F.array().cast(_NAME_TYPE),
        "flushed": F.array().cast(f"array<{_NAME_TYPE}>"),
    }

    def step(acc: Column, x: Column) -> Column:
        cls = x["cls"]
        alias, depth, extract_depth = acc["alias"], acc["depth"], acc["extract_depth"]
        in_extract = extract_depth > 0

        def put(**changes: Column | int | bool) -> Column:
            return F.struct(
                *[
                    (F.lit(v) if not isinstance(v, Column) else v).alias(f)
                    for f, v in ((f, changes.get(f, acc[f])) for f in start)
                ]
            )

        def keeping(role: Column, token: Column | None = None) -> dict[str, Column]:
            name = F.struct(
                x["at"].alias("at"),
                (x["text"] if token is None else token).alias("token"),
                role.alias("role"),
                (cls >= JOINED).alias("joined"),
            )
            full = F.size(acc["recent"]) >= FLUSH
            return {
                "recent": F.when(full, F.array(name)).otherwise(
                    F.concat(acc["recent"], F.array(name))
                ),
                "flushed": F.when(
                    full, F.concat(acc["flushed"], F.array(acc["recent"]))
                ).otherwise(acc["flushed"]),
            }

        def announced(role: Column) -> Column:
            """What the token changes when it belongs to no alias."""
            due = role != NOTHING
            named = F.when(due, NAMED).otherwise(SETTLED)
            closed = {"role": NOTHING, "alias": SETTLED, "extract": False}
            call = closed | {"depth": depth + 1}
            opened = F.when(acc["extract"] & ~in_extract, depth + 1).otherwise(extract_depth)
            left = F.when(depth <= extract_depth, 0).otherwise(extract_depth)

            def announces(new: int) -> Column:
                return put(role=new, alias=SETTLED, extract=False)

            return (
                F.when(cls.isin(W_OTHER, SINGLE_QUOTED), put(role=role, alias=named, extract=False))
                .when(cls == OPEN, put(**(call | {"extract_depth": opened})))
                .when(
                    cls == CLOSE,
                    put(
                        **closed,
                        depth=F.greatest(depth - 1, F.lit(0)),
                        extract_depth=left,
                    ),
                )
                .when(
                    cls.isin(NAME, JOINED),
                    F.when(
                        due, put(role=role, alias=NAMED, extract=False, **keeping(role))
                    ).otherwise(put(**closed)),
                )
                .when(cls.isin(NAME_CALL, JOINED_CALL), put(**call, **keeping(role)))
                .when(
                    cls.isin(NAME_DOT, JOINED_DOT),
                    F.when(due, put(**closed, **keeping(role))).otherwise(put(**closed)),
                )
                .when(
                    cls == W_FROM,
                    F.when(in_extract, put(role=role, alias=SETTLED)).otherwise(
                        announces(RELATION)
                    ),
                )
                .when(cls == W_JOIN, announces(RELATION))
                .when(cls == W_TABLE, announces(TABLE))
                .when(cls == W_CALL, announces(CALL))
                .when(cls.isin(W_CLOSING, SEMICOLON, SINGLE_DOT), put(**closed))
                .when(cls == W_EXTRACT, put(role=role, alias=SETTLED, extract=True))
                .when(cls <= LOOSE_COMMA, put(role=role, alias=SETTLED))
                .otherwise(put(role=role, alias=SETTLED, extract=False))
            )

        quiet = (alias == SETTLED) & (
            ((cls <= LAST_QUIET) & ~acc["extract"])
            | ((cls >= W_OTHER) & (acc["role"] == NOTHING) & ~acc["extract"])
        )
        # Past here a relation was just read: does the token belong to its alias?
        is_word = (cls >= W_EXTRACT) | cls.isin(W_PASSING, W_AS)
        free_word = is_word & ((alias == AS_READ) | ~F.upper(x["text"]).isin(*NO_ALIAS_WORDS))
        # "alias.rest": the first part is the alias and the dot ends the list of relations.
        cut_alias = cls.isin(NAME, NAME_CALL, NAME_DOT, JOINED_CALL, JOINED_DOT, SINGLE_DOT) & (
            (alias == AS_READ) | ~_starts_clause(x["text"])
        )
        after_cut = {
            "role": NOTHING,
            "alias": SETTLED,
            "depth": F.when(cls.isin(NAME_CALL, JOINED_CALL), depth + 1).otherwise(depth),
        }
        # What follows the dot may still be a name of two parts that is called.
        rest = F.regexp_replace(x["text"], rf"\A{lexis.FIRST_PART}{lexis.DOT}", "")
        rest_called = (cls == NAME_CALL) & F.contains(rest, F.lit("."))
        unread = announced(F.lit(NOTHING))
        return (
            F.when(quiet, acc)
            .when(cls == IDLE_RUN, put(role=NOTHING, alias=SETTLED, extract=False))
            .when(alias == SETTLED, announced(acc["role"]))
            .when(cls == COMMA, put(alias=SETTLED))
            .when(alias == ALIASED, unread)
            .when(cls == LOOSE_COMMA, put(alias=SETTLED))
            .when((alias == NAMED) & (cls == W_AS), put(alias=AS_READ))
            .when(free_word | cls.isin(SINGLE_QUOTED, JOINED), put(alias=ALIASED))
            .when(
                cut_alias,
                F.when(
                    rest_called, put(**after_cut, **keeping(F.lit(NOTHING), rest))
                ).otherwise(put(**after_cut)),
            )
            .otherwise(unread)
        )

    return F.aggregate(
        _classed(tokens),
        F.struct(*[v.alias(f) for f, v in start.items()]),
        step,
        lambda acc: F.concat(F.flatten(acc["flushed"]), acc["recent"]),
    )


def _parts(name: Column) -> Column:
    found = F.regexp_extract_all(name["token"], F.lit(lexis.NAME_PART), F.lit(1))
    plain = F.transform(
        F.filter(found, lambda p: p != ""), lambda p: F.replace(p, F.lit("`"), F.lit(""))
    )
    joined = F.split(F.regexp_extract(name["token"], r"\A`([^`]*+)`", 1), r"\.")
    return F.when(name["joined"], joined).otherwise(plain)


def object_type(role: Column, call: Column, obj: Column) -> Column:
    """What a name refers to, judged by its place."""
    return (
        F.when(role == CALL, "PROCEDURE")
        .when((role == RELATION) & call, "TABLE_VALUED_FUNCTION")
        .when(
            role.isin(RELATION, TABLE) & ~call,
            F.when(F.contains(F.upper(obj), F.lit(METADATA_SCHEMA)), "TABLE").otherwise("VIEW"),
        )
        .otherwise("SCALAR_FUNCTION")
    )


def located(names: Column) -> Column:
    """Kept names with their parts read.

    Gives ``array<struct<at, width, dataset_id, object_id, object_type, has_project, metadata>>``;
    ``width`` is the length of the name in its token, and ``metadata`` marks ``dataset.INFORMATION_SCHEMA.x``, which has no project although three parts.
    """

    def read(item: Column) -> Column:
        name, parts = item["name"], item["parts"]
        size = F.size(parts)
        part = [F.get(parts, F.lit(i)) for i in range(4)]
        metadata = (
            (size == 3) & (F.upper(part[1]) == METADATA_SCHEMA) & ~name["joined"]
        )
        obj = (
            F.when(size == 4, F.concat_ws(".", part[2], part[3]))
            .when(metadata, F.concat_ws(".", part[1], part[2]))
            .when(size == 3, part[2])
            .otherwise(part[1])
        )
        return F.struct(
            name["at"].alias("at"),
            F.length(name["token"]).alias("width"),
            F.when((size == 2) | metadata, part[0]).otherwise(part[1]).alias("dataset_id"),
            obj.alias("object_id"),
            object_type(name["role"], name["token"].endswith("("), obj).alias("object_type"),
            ((size > 2) & ~metadata).alias("has_project"),
            metadata.alias("metadata"),
        )

    with_parts = F.transform(
        names, lambda n: F.struct(n.alias("name"), _parts(n).alias("parts"))
    )
    return F.transform(with_parts, read)


def is_foreign(dataset: Column, home_dataset: Column) -> Column:
    """Not in the script's own dataset, case aside; with no own dataset, all are foreign."""
    home = F.coalesce(home_dataset, F.lit(""))
    return (home == "") | (F.lower(dataset) != F.lower(home))


def foreign_datasets(names: Column, home_dataset: Column) -> Column:
    return F.array_sort(
        F.array_distinct(
            F.transform(
                F.filter(
                    names,
                    lambda n: (n["dataset_id"] != "") & is_foreign(n["dataset_id"], home_dataset),
                ),
                lambda n: n["dataset_id"],
            )
        )
    )


def without_self(names: Column, home_dataset: Column, home_object: Column) -> Column:
    """Drop names with an empty part and the script's own name (case matters)."""
    own_known = (F.coalesce(home_dataset, F.lit("")) != "") & (
        F.coalesce(home_object, F.lit("")) != ""
    )
    return F.filter(
        names,
        lambda n: (n["dataset_id"] != "")
        & (n["object_id"] != "")
        & ~F.coalesce(
            own_known & (n["dataset_id"] == home_dataset) & (n["object_id"] == home_object),
            F.lit(False),
        ),
    )


def first_uses(names: Column) -> Column:
    """One entry per (dataset, object), sorted by both, with the type of its first use."""
    by_key = F.array_sort(
        F.transform(
            names,
            lambda n: F.struct(
                n["dataset_id"].alias("dataset_id"),
                n["object_id"].alias("object_id"),
                n["at"].alias("at"),
                n["object_type"].alias("object_type"),
            ),
        )
    )

    def leads(ordered: Column) -> Column:
        def differs(n: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)
            return (
                (i == 0)
                | (before["dataset_id"] != n["dataset_id"])
                | (before["object_id"] != n["object_id"])
            )

        return F.filter(ordered, differs)

    return F.transform(
        let(by_key, leads),
        lambda n: F.struct(
            n["dataset_id"].alias("dataset_id"),
            n["object_id"].alias("object_id"),
            n["object_type"].alias("object_type"),
            F.when(n["object_type"].isin("VIEW", "TABLE"), "VIEW")
            .otherwise("ROUTINE")
            .alias("resource_type"),
        ),
    )


def with_project(
    pieces: Column, tokens: Column, names: Column, home_dataset: Column, project: Column
) -> Column:
    """The body with the project put before each foreign name that has none.

    ``pieces`` and ``tokens`` must be columns of the row, not expressions: each name looks one up.
    """
    targets = F.filter(
        names,
        lambda n: ~n["has_project"]
        & n["dataset_id"].isNotNull()
        & is_foreign(n["dataset_id"], home_dataset),
    )

    def spelled(n: Column) -> Column:
        token = F.get(tokens, n["at"])
        piece = F.get(pieces, n["at"])
        gap = F.left(piece, F.length(piece) - n["width"])
        quoted = [
            F.concat(F.lit("`"), part, F.lit("`"))
            for part in (project, n["dataset_id"], n["object_id"])
        ]
        obj = F.when(n["metadata"], n["object_id"]).otherwise(quoted[2])
        tail = F.regexp_extract(token, rf"(\(|{lexis.GAP}\.)\z", 1)
        return F.concat(gap, F.concat_ws(".", quoted[0], quoted[1], obj), tail)

    def rebuilt(target: Column) -> Column:
        # Between two rewritten names the pieces are joined as they are.
        def upto(n: Column, i: Column) -> Column:
            last = F.when(i == 0, -1).otherwise(F.get(target, i - 1)["at"])
            kept = F.slice(pieces, last + 2, n["at"] - last - 1)
            return F.concat(F.array_join(kept, ""), spelled(n))

        last = F.coalesce(F.get(target, F.size(target) - 1)["at"], F.lit(-1))
        rest = F.slice(pieces, last + 2, F.size(pieces))
        return F.concat(F.array_join(F.transform(target, upto), ""), F.array_join(rest, ""))

    return let(targets, rebuilt)
