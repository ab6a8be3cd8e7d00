"""Clean-up of script text: column in, column out, no shuffle and no Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptloom.functions import lexis

# The Unicode White_Space characters.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + (
    "\u2028\u2029\u202f\u205f\u3000"
)

PROJECT_PLACEHOLDER = "${project}"

# An unclosed block comment runs to the last character but one: that one stays.
_STRIPPED_COMMENT = r"--[^\n]*+|/\*(?:[\s\S]*?\*/|[\s\S]*(?=[\s\S]\z)|)"
_KEPT_OR_COMMENT = rf"({lexis.STRING}|{lexis.BACKTICK})|{_STRIPPED_COMMENT}"


def trim_edges(text: Column) -> Column:
    """Drop white space, and with it blank lines, from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def dedent(text: Column) -> Column:
    """Drop the run of blanks and tabs that all non-blank lines start with."""
    leads = F.regexp_extract_all(text, F.lit(r"(?mdU)^([ \t]*+)(?=[^\S\n]*+\S)"), F.lit(1))
    # The common start of the least and the greatest run is the common start of all runs.
    ends = F.concat_ws("\n", F.array_min(leads), F.array_max(leads))
    common = F.regexp_extract(ends, r"\A([ \t]*)[ \t]*\n\1", 1)
    line_end = F.lit("\n")
    cut = F.replace(F.concat(line_end, text), F.concat(line_end, common), line_end)
    return F.when(common != "", F.substr(cut, F.lit(2))).otherwise(text)


def strip_comments(text: Column) -> Column:
    """Remove line and block comments outside strings and backticked names."""
    return F.regexp_replace(text, _KEPT_OR_COMMENT, "$1")


def clean_body(
    text: Column,
    trim_body: bool = True,
    trim_comments: bool = False,
    trim_indentation: bool = True,
) -> Column:
    """Indentation, then comments, then edges, each only where its flag is set."""
    if trim_indentation:
        text = dedent(text)
    if trim_comments:
        text = strip_comments(text)
    if trim_body:
        text = trim_edges(text)
    return text


def fill_project(text: Column, project: Column) -> Column:
    """Put the project in place of each placeholder; an empty or null project changes nothing."""
    return F.when(
        F.coalesce(project, F.lit("")) != "",
        F.replace(text, F.lit(PROJECT_PLACEHOLDER), project),
    ).otherwise(text)
