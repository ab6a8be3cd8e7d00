"""The body of a CREATE script: what stands after the header's AS, or from its BEGIN on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptloom.functions import lexis
from scriptloom.functions.binding import let
from scriptloom.functions.header import VIEW_KINDS

_QUOTED = r"\A(?:[rR][ \t]*+)?(\"\"\"|''')([\s\S]*?)\1"
_QUOTED_START = r"\A(?:[rR][ \t]*+)?(?:\"\"\"|''')"
# From the line's first blank up to a semicolon outside strings and backticks.
_STATEMENT = (
    rf"\A(?:[ \t]*+[\n\r]++)*+([ \t]*+(?:[^'\"`;]++|{lexis.SINGLE}|{lexis.BACKTICK})*+)"
)
_COMMENT = rf"{lexis.LINE_COMMENT}|{lexis.BLOCK_COMMENT}"
_PAREN_TOKEN = rf"({lexis.STRING}|{lexis.BACKTICK}|{_COMMENT}|[()]|[^()'\"`/-]++|[\s\S])"

# Texts nested deeper than this are folded token by token.
NESTED = 8
_PAREN_GROUP = (
    r"\A\("
    + lexis.nested(r"\(", rf"[^()'\"`/-]++|{lexis.STRING}|{lexis.BACKTICK}|{_COMMENT}|[/-]", r"\)", NESTED)
    + r"\)"
)

# The words that open a block, and with END in front close it.
BLOCK_WORDS = ("CASE", "IF", "WHILE", "LOOP", "FOR", "REPEAT")

# IF( and REPEAT( are function calls and FOR SYSTEM_TIME is a table clause: none opens a block.
_ANY_BLOCK_WORD = rf"(?i:BEGIN|END|{'|'.join(BLOCK_WORDS)}){lexis.WORD_END}"
_NOT_A_BLOCK = rf"(?i:IF|REPEAT)\(|(?i:FOR\s++SYSTEM_TIME){lexis.WORD_END}"
_BLOCK_TOKEN = (
    rf"({lexis.STRING}|{lexis.BACKTICK}|{_COMMENT}"
    rf"|(?i:END(?:\s++(?:{'|'.join(BLOCK_WORDS)}))?+){lexis.WORD_END}"
    rf"|(?:{_NOT_A_BLOCK}|(?!{_ANY_BLOCK_WORD}){lexis.WORD}|[^\p{{L}}_@'\"`/-])++"
    rf"|{lexis.WORD}|[\s\S])"
)

# A block whose words all meet their ENDs in order. Within CASE only CASE may open: there a plain END
# of a BEGIN would count for the CASE.
_WORDS = "|".join(BLOCK_WORDS)
_CONTROL_WORDS = "|".join(w for w in BLOCK_WORDS if w != "CASE")
_BLOCK_ATOM = (
    rf"(?:{_NOT_A_BLOCK}|(?!{_ANY_BLOCK_WORD}){lexis.WORD}|[^\p{{L}}_@'\"`/-]++)++"
    rf"|{lexis.STRING}|{lexis.BACKTICK}|{_COMMENT}|[/-]"
)
_END_WORD = rf"(?i:END){lexis.WORD_END}"
_PLAIN = rf"(?!\s++(?i:{_WORDS}){lexis.WORD_END})"
_CASE_OPEN = rf"(?i:CASE){lexis.WORD_END}"
_CASE_CLOSE = rf"{_END_WORD}(?:{_PLAIN}|\s++{_CASE_OPEN})"
_IN_BLOCK = rf"{_BLOCK_ATOM}|{_CASE_OPEN}{lexis.nested(_CASE_OPEN, _BLOCK_ATOM, _CASE_CLOSE, 2)}{_CASE_CLOSE}"


def _block_group(levels: int) -> str:
    """The leading block with at most ``levels`` of blocks in it."""
    inner = f"(?:{_IN_BLOCK})*+"
    for level in range(levels, 0, -1):
        # The group holds the control word, or nothing for BEGIN. Right behind END no word can stand, so
        # only the END of a BEGIN is plain.
        word = rf"\k<w{level}>"
        opener = rf"(?i:(?<w{level}>{_CONTROL_WORDS}|(?=BEGIN))(?:BEGIN)?+){lexis.WORD_END}"
        closer = rf"{_END_WORD}(?:(?i:{word}){_PLAIN}|\s++(?i:{word}){lexis.WORD_END})"
        inner = f"(?:{_IN_BLOCK}|{opener}{inner}{closer})*+"
    return rf"\A(?i:BEGIN){lexis.WORD_END}{inner}{_END_WORD}{_PLAIN}"


_BLOCK_GROUP = _block_group(4)


def paren_length(text: Column) -> Column:
    """Length of the leading parenthesised group with both parens, 0 where it is not closed."""
    matched = F.length(F.regexp_extract(text, _PAREN_GROUP, 0))
    return let(matched, lambda n: F.when(n > 0, n).otherwise(_folded_parens(text)))


def _folded_parens(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_PAREN_TOKEN), F.lit(1))
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(acc: Column, token: Column) -> Column:
        at = acc["at"] + F.length(token)
        depth = (
            F.when(token == "(", acc["depth"] + 1)
            .when(token == ")", acc["depth"] - 1)
            .otherwise(acc["depth"])
        )
        closed = (token == ")") & (acc["depth"] == 1)
        moved = F.struct(
            depth.alias("depth"), at.alias("at"), F.when(closed, at).otherwise(0).alias("end")
        )
        return F.when(acc["end"] > 0, acc).otherwise(moved)

    return F.aggregate(tokens, start, step, lambda acc: acc["end"])


def block_length(text: Column) -> Column:
    """Length of the leading BEGIN…END block, 0 where it is not closed.

    A plain END closes the innermost CASE expression, else the innermost BEGIN. The block counts as
    closed only if every control word in it met its END; an END of a word not open is passed over.
    """
    matched = F.length(F.regexp_extract(text, _BLOCK_GROUP, 0))
    return let(matched, lambda n: F.when(n > 0, n).otherwise(_folded_block(text)))


def _folded_block(text: Column) -> Column:
    tokens = F.regexp_extract_all(text, F.lit(_BLOCK_TOKEN), F.lit(1))
    words = [w.lower() for w in BLOCK_WORDS]
    start = F.struct(
        F.lit(0).alias("begin"),
        *[F.lit(0).alias(w) for w in words],
        F.lit(0).alias("at"),
        F.lit(0).alias("end"),
    )

    def step(acc: Column, token: Column) -> Column:
        word = F.upper(token)
        at = acc["at"] + F.length(token)
        plain_end = word == "END"
        closes_begin = plain_end & (acc["case"] == 0)
        begin = (
            F.when(word == "BEGIN", acc["begin"] + 1)
            .when(closes_begin, acc["begin"] - 1)
            .otherwise(acc["begin"])
        )

        def open_count(w: str) -> Column:
            closes = word.rlike(rf"\AEND\s+{w}\z")
            if w == "CASE":
                closes = closes | plain_end
            count = acc[w.lower()]
            return (
                F.when(word == w, count + 1)
                .when(closes, F.greatest(count - 1, F.lit(0)))
                .otherwise(count)
            )

        all_met = sum((acc[w] for w in words[1:]), F.lit(0)) == 0
        last = closes_begin & (acc["begin"] == 1)
        moved = F.struct(
            begin.alias("begin"),
            *[open_count(w).alias(w.lower()) for w in BLOCK_WORDS],
            at.alias("at"),
            F.when(last & all_met, at).when(last, F.lit(-1)).otherwise(0).alias("end"),
        )
        # Most tokens are not block words and only move the position.
        passed = F.struct(
            acc["begin"],
            *[acc[w].alias(w) for w in words],
            at.alias("at"),
            acc["end"],
        )
        block_word = word.isin("BEGIN", *BLOCK_WORDS) | word.startswith("END")
        return (
            F.when(acc["end"] != 0, acc).when(block_word, moved).otherwise(passed)
        )

    return F.aggregate(tokens, start, step, lambda acc: F.greatest(acc["end"], F.lit(0)))


def body_of(after_header: Column, kind: Column) -> Column:
    """The body as written, or null where its paren, quote or block is not closed.

    ``after_header`` starts behind AS, or at BEGIN.
    """
    return let(
        after_header, lambda given: let(F.ltrim(given, F.lit(" \t\n\r")), lambda text: _body(given, text, kind))
    )


def _body(given: Column, text: Column, kind: Column) -> Column:
    statement = F.regexp_extract(given, _STATEMENT, 1)
    quoted = F.regexp_extract(text, _QUOTED, 1)

    def in_parens(paren: Column) -> Column:
        rest = F.substring(text, paren + 1, F.length(text))
        # "(…) UNION ALL (…)" is one view query; nothing else goes on after the paren.
        goes_on = kind.isin(*VIEW_KINDS) & ~rest.rlike(rf"\A(?:\s|{_COMMENT})*+(?:;|\z)")
        return F.when(
            paren > 0,
            F.when(goes_on, statement).otherwise(F.substring(text, F.lit(2), paren - 2)),
        )

    def as_block(block: Column) -> Column:
        return F.when(block > 0, F.substring(text, F.lit(1), block))

    return (
        F.when(text.startswith("("), let(paren_length(text), in_parens))
        .when(
            text.rlike(_QUOTED_START), F.when(quoted != "", F.regexp_extract(text, _QUOTED, 2))
        )
        .when(text.rlike(r"\A(?i:BEGIN)"), let(block_length(text), as_block))
        .otherwise(statement)
    )
