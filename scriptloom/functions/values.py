"""Values written in scripts: option literals, intervals, lists, pairs and type names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptloom.functions import lexis
from scriptloom.functions.binding import let
from scriptloom.functions.text import trim_edges

# Type names that stand for another one.
TYPE_ALIASES = {
    "INT": "INT64",
    "INTEGER": "INT64",
    "SMALLINT": "INT64",
    "BIGINT": "INT64",
    "BYTEINT": "INT64",
    "FLOAT": "FLOAT64",
    "DOUBLE": "FLOAT64",
    "BOOLEAN": "BOOL",
    "DEC": "NUMERIC",
    "BIGDECIMAL": "BIGNUMERIC",
}

_UNIT_INTERVAL = (
    r"(?i)^INTERVAL\s+(\d+)\s+(YEAR|MONTH|DAY|HOUR|MINUTE|SECOND)S?\s*$"
)
_CLOCK_INTERVAL = r"""(?i)^INTERVAL\s+["']([^"']+)["']\s+HOUR\s+TO\s+SECOND\s*$"""
_CANONICAL_INTERVAL = r"^\d+-\d+ \d+ \d+:\d+:\d+(\.\d+)?$"
_CLOCK = r"^[+-]?\d+(:[+-]?\d+){0,2}$"


def null_if_empty(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def unescape(quoted: Column) -> Column:
    """The text of a quoted literal: quotes off, a backslash stands for the sign after it."""
    inner = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return F.regexp_replace(inner, r"\\([\s\S])", "$1")


def unquote(value: Column) -> Column:
    """Take one pair of equal quotes off, if there is one."""
    return F.regexp_replace(trim_edges(value), r"""\A(["'])([\s\S]*)\1\z""", "$2")


def bare_name(name: Column) -> Column:
    return F.regexp_replace(name, r"\A`([^`]*+)`\z", "$1")


def option_value(raw: Column) -> Column:
    """One option's value as text: strings unescaped, lists as written, intervals on one line."""
    one_line = F.regexp_replace(raw, r"\s+", " ")
    requoted = F.regexp_replace(one_line, r"'([^']*+)'", '"$1"')
    return (
        F.when(raw.rlike(rf"\A{lexis.SINGLE_CLOSED}\z"), unescape(raw))
        .when(raw.startswith("["), raw)
        .when(raw.startswith("`"), bare_name(raw))
        .otherwise(requoted)
    )


def string_list(value: Column) -> Column:
    """``['a', "b"]`` or one plain text as an array; null stays null."""
    inner = F.regexp_replace(value, r"\A\[|\]\z", "")
    pieces = F.regexp_extract_all(
        inner, F.lit(r"""((?:"[^"]*+"?|'[^']*+'?|[^,"']++)++)"""), F.lit(1)
    )
    listed = F.filter(F.transform(pieces, trim_edges), lambda piece: piece != "")
    return (
        F.when(value.startswith("["), F.transform(listed, unquote))
        .when(value != "", F.array(unquote(value)))
        .when(value == "", F.array().cast("array<string>"))
    )


def last_entries(entries: Column) -> Column:
    """Entries ``(key, value)`` with only the last one of each key, in the order of writing."""
    def kept(latest: Column) -> Column:
        keys = F.transform(latest, lambda e: e["key"])
        return let(
            keys,
            lambda found: F.filter(
                latest, lambda e, i: F.array_position(found, e["key"]) == i + 1
            ),
        )

    return F.reverse(let(F.reverse(entries), kept))


def pair_map(value: Column) -> Column:
    """``[("k", "v"), …]`` as a map; the last value of a key wins."""
    # One pair: two items, quoted or not, between a paren and a comma or paren.
    item = r"""((?:"[^"]*+"?|'[^']*+'?|[^,"'()]++)++)"""
    pair = F.lit(rf"\({item},{item}[,)]")
    trimmed = F.lit(" \t\"'")
    keys = F.transform(
        F.regexp_extract_all(value, pair, F.lit(1)), lambda k: F.btrim(k, trimmed)
    )
    values = F.transform(
        F.regexp_extract_all(value, pair, F.lit(2)), lambda v: F.btrim(v, trimmed)
    )
    entries = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("key"), v.alias("value")))
    return F.map_from_entries(last_entries(entries))


def truth(value: Column) -> Column:
    """``true`` in any case is true, other text false, no text null."""
    return F.when(value.isNotNull(), F.lower(value) == "true")


def minutes_to_millis(value: Column) -> Column:
    number = F.when(
        value.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), value.try_cast("double")
    )
    return (number * 60000).try_cast("bigint")


def normalize_interval(value: Column) -> Column:
    """An interval as ``Y-M D H:M:S``; hours, minutes and seconds carry, longer units do not."""
    zero = F.lit("0")

    def spelled(years, months, days, hours, minutes, secs) -> Column:
        date = F.concat_ws(" ", F.concat_ws("-", years, months), days)
        return F.concat_ws(" ", date, F.concat_ws(":", hours, minutes, secs))

    def by_unit(read: Column) -> Column:
        number, unit = read["number"], read["unit"]
        plain = number.cast("string")

        def carried(seconds: Column) -> Column:
            hours = ((seconds - seconds % 3600) / 3600).cast("bigint")
            minutes = ((seconds % 3600 - seconds % 60) / 60).cast("bigint")
            clock = [c.cast("string") for c in (hours, minutes, seconds % 60)]
            # null if the seconds overflow: the value then stays as written
            return F.when(seconds.isNotNull(), spelled(zero, zero, zero, *clock))

        scale = F.when(unit == "HOUR", 3600).when(unit == "MINUTE", 60).otherwise(1)
        return F.when(
            number.isNotNull(),
            F.when(unit == "YEAR", spelled(plain, zero, zero, zero, zero, zero))
            .when(unit == "MONTH", spelled(zero, plain, zero, zero, zero, zero))
            .when(unit == "DAY", spelled(zero, zero, plain, zero, zero, zero))
            .otherwise(let(F.try_multiply(number, scale.cast("bigint")), carried)),
        )

    def by_clock(clock: Column) -> Column:
        parts = [
            F.coalesce(
                F.get(F.split(clock, ":"), F.lit(i)).try_cast("bigint"), F.lit(0)
            ).cast("string")
            for i in range(3)
        ]
        return F.when(clock.rlike(_CLOCK), spelled(zero, zero, zero, *parts))

    def normalized(text: Column) -> Column:
        read = F.struct(
            F.regexp_extract(text, _UNIT_INTERVAL, 1).try_cast("bigint").alias("number"),
            F.upper(F.regexp_extract(text, _UNIT_INTERVAL, 2)).alias("unit"),
        )
        clock = trim_edges(F.regexp_extract(text, _CLOCK_INTERVAL, 1))
        return (
            F.when((text == "") | text.rlike(_CANONICAL_INTERVAL), text)
            .when(text.rlike(_UNIT_INTERVAL), let(read, by_unit))
            .when(text.rlike(_CLOCK_INTERVAL), let(clock, by_clock))
        )

    # Where nothing fits, the value stays as it was written.
    return F.when(
        value.isNotNull(), F.coalesce(let(trim_edges(value), normalized), value)
    )


def normalize_type(text: Column) -> Column:
    """Type text with parameters dropped, aliases resolved and one blank between words.

    Words in the place of a type change; field names inside ``STRUCT<…>`` stay as written.
    """
    plain = F.regexp_replace(text, r"\([^()]*+\)", "")
    plain = F.regexp_replace(plain, r"\s*([<>,])\s*", "$1")
    plain = F.regexp_replace(trim_edges(plain), r"\s+", " ")
    # A type word is the one before '<', ',', '>' or the end.
    aliases = F.create_map(*[F.lit(x) for pair in TYPE_ALIASES.items() for x in pair])

    def resolved(words: Column) -> Column:
        def by_place(word: Column, i: Column) -> Column:
            follower = F.get(words, i + 1)
            is_type = follower.isNull() | follower.isin("<", ",", ">")
            upper = F.upper(word)
            return F.when(
                is_type & ~word.isin("<", ">", ",", " "), F.coalesce(aliases[upper], upper)
            ).otherwise(word)

        return F.transform(words, by_place)

    words = F.regexp_extract_all(plain, F.lit(r"([^<>, ]++|[<>, ])"), F.lit(1))
    spelled = F.array_join(let(words, resolved), "")
    return null_if_empty(F.regexp_replace(spelled, ",", ", "))


def type_json(normal: Column) -> Column:
    """A type as ``normalize_type`` spells it, as the JSON tree of the warehouse's type objects.

    ``{"typeKind": …}`` with ``arrayElementType``, ``structType.fields`` or ``tableType.columns``
    for nested ones; a field without a name has a type only. No type stays null.
    """
    # The JSON form of nested types, before and after their elements.
    opened = {
        "A": '{"typeKind":"ARRAY","arrayElementType":',
        "S": '{"typeKind":"STRUCT","structType":{"fields":[',
        "T": '{"tableType":{"columns":[',
    }
    closed = {"A": "}", "S": "]}}", "T": ']},"typeKind":"TABLE"}'}
    empty = {"A": opened["A"] + '{"typeKind":""}}', "S": '{"typeKind":"STRUCT","structType":{}}',
             "T": '{"typeKind":"TABLE"}'}

    def scalar(word: Column) -> Column:
        return F.concat(F.lit('{"typeKind":"'), word, F.lit('"}'))

    # A token is a word with the blank or "<" after it, ">" or ",".
    tokens = F.regexp_extract_all(normal, F.lit(r"([^<>, ]++[ <]?+|>|, ?+)"), F.lit(1))
    # ``stack`` has a letter for each open bracket; ``due`` is what comes next: a name, a type, nothing.
    start = F.struct(F.lit("").alias("out"), F.lit("").alias("stack"), F.lit("type").alias("due"))

    def step(acc: Column, token: Column) -> Column:
        out, stack, due = acc["out"], acc["stack"], acc["due"]
        top = F.right(stack, F.lit(1))
        in_fields = top.isin("S", "T")
        word = F.regexp_replace(token, r"[ <`]", "")
        # a field begins where a name is due, with a comma unless it is the first
        field = F.when(due == "name", F.concat(F.when(out.endswith("}"), ",").otherwise(""), F.lit("{")))
        field = F.coalesce(field, F.lit(""))
        typed = F.concat(out, field, F.when(due == "name", '"type":').otherwise(""))

        def put(out: Column, stack: Column, due: str | Column) -> Column:
            due = due if isinstance(due, Column) else F.lit(due)
            return F.struct(out.alias("out"), stack.alias("stack"), due.alias("due"))

        def opener(letter: str, due: str) -> Column:
            return put(F.concat(typed, F.lit(opened[letter])), F.concat(stack, F.lit(letter)), due)

        def closing(letter: str) -> Column:
            filled = F.concat(
                out,
                F.when(in_fields & (due != "name"), "}").otherwise(""),
                F.lit(closed[letter]),
            )
            bare = F.concat(
                F.substring(out, F.lit(1), F.length(out) - len(opened[letter])), F.lit(empty[letter])
            )
            return F.when(out.endswith(opened[letter]), bare).otherwise(filled)

        popped = F.substring(stack, F.lit(1), F.length(stack) - 1)
        name = F.regexp_replace(word, r'(["\\])', r"\\$1")
        return (
            F.when(
                token == ">",
                put(
                    F.when(top == "A", closing("A")).when(top == "S", closing("S"))
                    .when(top == "T", closing("T")).otherwise(out),
                    popped, "nothing",
                ),
            )
            .when(
                token.startswith(","),
                F.when(
                    in_fields & (due != "name"), put(F.concat(out, F.lit("}")), stack, "name")
                ).otherwise(acc),
            )
            .when(
                (due == "name") & token.endswith(" "),
                put(F.concat(out, field, F.lit('"name":"'), name, F.lit('","type":')), stack, "type"),
            )
            .when(
                token.endswith("<"),
                F.when(due == "nothing", put(out, F.concat(stack, F.lit("R")), due))
                .when(word == "ARRAY", opener("A", "type"))
                .when(word == "STRUCT", opener("S", "name"))
                .when(word == "TABLE", opener("T", "name"))
                .otherwise(put(F.concat(typed, scalar(word)), F.concat(stack, F.lit("R")), "nothing")),
            )
            .when(due == "nothing", acc)
            .otherwise(put(F.concat(typed, scalar(word)), stack, "nothing"))
        )

    nested = F.aggregate(tokens, start, step, lambda acc: acc["out"])
    return F.when(normal.contains("<"), nested).when(
        normal.isNotNull(), scalar(F.regexp_replace(normal, "`", ""))
    )


def table_columns_json(tree: Column) -> Column:
    """The ``columns`` object of a table type given as ``type_json``; null for any other type."""
    columns = F.regexp_extract(tree, r'\A\{"tableType":([\s\S]*),"typeKind":"TABLE"\}\z', 1)
    return null_if_empty(columns)
