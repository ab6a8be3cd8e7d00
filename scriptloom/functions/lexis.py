"""Patterns shared by the text functions.

Every repeat is possessive (``*+``) or a lazy single-character one, so that ``java.util.regex``
runs them as loops: no recursion and no backtracking, however long the script is.
"""

from __future__ import annotations

# --- fixed values: string, name and comment forms of the warehouse's SQL ---------------------

TRIPLE = r"(?:'''[\s\S]*?(?:'''|\z)|\"\"\"[\s\S]*?(?:\"\"\"|\z))"
SINGLE = r"(?:'(?:[^'\\]++|\\[\s\S]?)*+'?|\"(?:[^\"\\]++|\\[\s\S]?)*+\"?)"
SINGLE_CLOSED = r"(?:'(?:[^'\\]++|\\[\s\S])*+'|\"(?:[^\"\\]++|\\[\s\S])*+\")"
STRING = f"(?:{TRIPLE}|{SINGLE})"
BACKTICK = r"(?:`[^`]*+`?)"
LINE_COMMENT = r"--[^\n]*+"
BLOCK_COMMENT = r"/\*[\s\S]*?(?:\*/|\z)"

# --- statement headers ------------------------------------------------------------------------

# A word of a statement header, keyword or name.
WORD = r"(?:[\p{L}_@][\p{L}\p{Nd}_$@]*+)"
WORD_END = r"(?![\p{L}\p{Nd}_$@])"
# The header ends before the first of these words.
BODY_WORD = rf"(?i:AS|BEGIN){WORD_END}"
HEADER_COMMENT = rf"(?:{LINE_COMMENT}|{BLOCK_COMMENT})"
# Characters a header may hold between words, strings and names.
HEADER_SIGN = r"[()\[\]<>,.=;*!|&+\-/%\p{Nd}]"
HEADER = (
    rf"\A(?:(?U:\s)|{HEADER_COMMENT}|{SINGLE_CLOSED}|`[^`]*+`|(?!{BODY_WORD}){WORD}|{HEADER_SIGN})*+"
)

# --- statement bodies -------------------------------------------------------------------------

# What may stand between two tokens of a body.
GAP = rf"(?:[ \t\n\r]|{LINE_COMMENT}|{BLOCK_COMMENT})*+"
BARE = r"[A-Za-z_][A-Za-z0-9_-]*+"
QUOTED_PART = r"[\p{L}_][\p{L}\p{Nd}_-]*+"
PART = rf"(?:{BARE}|`{QUOTED_PART}`)"
FIRST_PART = rf"(?:{BARE}|`[^`.]*+`)"
DOT = rf"{GAP}\.{GAP}"
METADATA_PART = r"(?:(?i:INFORMATION_SCHEMA)(?![A-Za-z0-9_-])|`(?i:INFORMATION_SCHEMA)`)"
# A name keeps a paren that touches it, or a dot that leads to no further part.
NAME_TAIL = rf"(?:\(|{GAP}\.)?"

JOINED_NAME = rf"`{QUOTED_PART}(?:\.{QUOTED_PART}){{1,2}}`{NAME_TAIL}"
METADATA_NAME = rf"{FIRST_PART}{DOT}{PART}{DOT}{METADATA_PART}{DOT}{PART}(?!{DOT}{PART}){NAME_TAIL}"
DOTTED_NAME = rf"{FIRST_PART}(?:{DOT}{PART}){{1,2}}+(?!{DOT}{PART}){NAME_TAIL}"
OPEN_NAME = rf"{FIRST_PART}{GAP}\.(?!{GAP}{PART})"
LONE_QUOTED = rf"`[^`.]*+`(?!{DOT}{PART})"
OTHER = r"[^A-Za-z_'\"`(),;\s/-]++|[\s\S]"

# Group 0 is a token with the gap before it, so the matches tile the body; group 1 is the token.
# A comma keeps its gap inside group 1: "," touches the token before it, " ," does not.
BODY_TOKEN = (
    rf"(?:{GAP}(?!,))?+"
    rf"({STRING}|{GAP},|{JOINED_NAME}|{METADATA_NAME}|{DOTTED_NAME}|{OPEN_NAME}|{LONE_QUOTED}"
    rf"|{BARE}|[();]|{OTHER}|\z)"
)



def one_of(words: tuple[str, ...]) -> str:
    """A pattern for any of ``words`` in any case, branching letter by letter."""
    by_first: dict[str, list[str]] = {}
    for word in words:
        if word:
            by_first.setdefault(word[0], []).append(word[1:])
    branches = [letter + one_of(tuple(rest)) for letter, rest in sorted(by_first.items())]
    tail = "(?:" + "|".join(branches) + ")" if len(branches) != 1 else branches[0]
    return (f"(?:{tail})?+" if "" in words else tail) if branches else ""


def name_token(clause_words: tuple[str, ...], telling_words: tuple[str, ...], closing_words: tuple[str, ...]) -> str:
    """``BODY_TOKEN`` where stretches in which no name can be kept are no tokens, or one.

    Behind a paren, a semicolon, or where the body begins, nothing is announced. It stays so until a telling word,
    a call with a dotted name or a paren that does not close right away, so what stands before that is counted to
    the gap. An idle word is bare, none of ``clause_words``, and no part of a dotted name. Whatever was announced
    before them, after four of them nothing is: a relation, its alias, the end of the list. The same holds
    behind a closing word and one token more, unless that is a comma that touches it: the word could be an alias.
    """

    def any_of(words: tuple[str, ...]) -> str:
        return rf"(?i:{one_of(words)})(?![A-Za-z0-9_-])"

    lone = rf"{BARE}(?!{GAP}\.)"
    gap = rf"(?:{GAP}(?!,))?+"
    token = (
        rf"(?![()]|{any_of(telling_words)})(?>{lone}|{STRING}|{GAP},|{JOINED_NAME}|{METADATA_NAME}|{DOTTED_NAME}"
        rf"|{OPEN_NAME}|{LONE_QUOTED}|{BARE}|;|{OTHER})(?<!\()"
    )
    passed = rf"(?:{gap}(?:\((?:{gap}{token})*+{GAP}\)|{token}))"
    idle = rf"(?!{any_of(clause_words)}){lone}"
    run = rf"{idle}(?:{GAP}{idle}){{3,}}+{passed}*+"
    closing = rf"(?={any_of(closing_words)}){lone}(?!,){passed}++"
    tokens = BODY_TOKEN.replace(rf"({STRING}|", rf"({run}|{closing}|{lone}|{STRING}|", 1)
    return rf"(?:(?<=[();]){passed}*+|\A{passed}*+)?+{tokens}"


# The parts of one name token; comments between the parts give empty matches.
NAME_PART = rf"(`[^`]*+`|{BARE})|{LINE_COMMENT}|{BLOCK_COMMENT}"


def nested(opener: str, atom: str, closer: str, levels: int) -> str:
    """A pattern for what stands between ``opener`` and ``closer``, with at most ``levels`` of the same in it.

    Every repeat is possessive, so a text that fits is read once; one that is deeper or not closed does not match.
    """
    inner = f"(?:{atom})*+"
    for _ in range(levels):
        inner = f"(?:{atom}|{opener}{inner}{closer})*+"
    return inner
