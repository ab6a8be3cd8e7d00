"""Scripts in, one catalog row per script out.

Everything here is projection: the corpus is read once, each script is worked on where it lies,
and no script text is ever shuffled. The stages are separate projections on purpose, so that a
stage's result (header, outline, body) is computed once and used by many columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.functions import body as bodies
from scriptloom.functions import header as headers
from scriptloom.functions import lexis, values
from scriptloom.functions.binding import built_once, keep_where, sealed, with_each
from scriptloom.functions.text import clean_body, trim_edges

ROUTINE, VIEW = "routine", "view"

_LIST = "array<string>"


def _option(name: str) -> Column:
    return F.col("_options")[name]


def _text(option: str) -> Column:
    return values.null_if_empty(_option(option))


def _unquoted(option: str) -> Column:
    return values.null_if_empty(values.unquote(_option(option)))


def _given(*options: str) -> Column:
    return F.arrays_overlap(F.map_keys("_options"), F.array(*[F.lit(o) for o in options]))


@built_once
def _header_columns() -> list[tuple[str, Column]]:
    """The trimmed script, its header, what follows it and the word that ends the header."""
    return [
        ("_sql", F.coalesce(trim_edges(F.col("sql")), F.lit(""))),
        ("_header", headers.header_text(F.col("_sql"))),
        ("_tail", F.substring(F.col("_sql"), F.length("_header") + 1, F.length("_sql"))),
        ("_ender", F.upper(F.regexp_extract("_tail", rf"\A{lexis.BODY_WORD}", 0))),
        ("_kind", headers.object_kind(F.col("_header"))),
    ]


def _options_column(parsed: Column) -> Column:
    """Options as a map with lower-case keys; the last one of a key counts."""
    entries = F.transform(
        F.filter(parsed, lambda p: F.size(p) > 1),
        lambda p: F.struct(
            F.lower(values.bare_name(F.get(p, F.lit(0)))).alias("key"),
            values.option_value(F.get(p, F.lit(1))).alias("value"),
        ),
    )
    return F.map_from_entries(values.last_entries(entries))


@built_once
def _stage_columns() -> list[tuple[str, Column]]:
    """Name, outline, options, raw body and the reason to reject."""
    is_view = F.col("_kind").isin(*headers.VIEW_KINDS)
    outline, items = F.col("_outlined.outline"), F.col("_outlined.items")
    named = F.regexp_extract("_header", headers.CREATE_NAME, 0)
    after_as = F.substring(F.col("_tail"), F.lit(3), F.length("_tail"))
    ends_with_as = F.col("_ender") == "AS"
    beyond = F.when(is_view, F.regexp_replace(outline, headers.VIEW_OUTLINE, "")).otherwise(
        F.regexp_replace(outline, headers.ROUTINE_OUTLINE, "")
    )
    first_items = headers.items_of(items, "")
    sound_items = headers.all_parsed(F.col("_option_parts")) & headers.all_parsed(
        F.col("_item_parts")
    )
    body_due = (F.col("_beyond") == "") & F.when(is_view, ends_with_as).otherwise(
        F.col("_ender") != ""
    )
    bodyless = ~is_view & (
        (F.coalesce(_option("endpoint"), F.lit("")) != "")
        | (F.coalesce(_option("main_file_uri"), F.lit("")) != "")
    )
    reason = (
        F.when(F.col("_sql") == "", "empty script")
        .when((F.col("_tail") != "") & (F.col("_ender") == ""), "bad character or open quote")
        .when(~F.col("_header").rlike(headers.CREATE), "not a CREATE statement")
        .when(F.col("_kind").isNull(), "unknown object kind")
        .when(F.col("_name") == "", "no object name")
        .when((F.col("_outlined.depth") != 0) | ~sound_items, "malformed header")
        .when(~F.col("_body_due") & ~bodyless & (F.col("_beyond") != ""), "malformed header")
        .when(~F.col("_body_due") & ~bodyless, "no body")
        .when(
            F.col("_body_due") & ends_with_as & (F.ltrim(after_as, F.lit(" \t\n\r")) == ""),
            "no body",
        )
        .when(F.col("_body_due") & F.col("_raw_body").isNull(), "unclosed body")
        .when(F.regexp_extract("_header", headers.CREATE_KIND, 1) != "", "temporary object")
    )
    return [
        ("_name", F.regexp_extract("_header", headers.CREATE_NAME, 3)),
        *headers.outline_columns(
            F.substring(F.col("_header"), F.length(named) + 1, F.length("_header"))
        ),
        ("_id", headers.name_parts(F.col("_name"))),
        ("_is_view", is_view),
        (
            "_item_parts",
            F.when(is_view, headers.parsed_columns(first_items)).otherwise(
                headers.parsed_arguments(first_items)
            ),
        ),
        ("_option_parts", headers.parsed_options(headers.items_of(items, "OPTIONS"))),
        ("_options", _options_column(F.col("_option_parts"))),
        ("_beyond", F.trim(beyond)),
        (
            "_raw_body",
            F.when(
                F.col("_ender") != "",
                bodies.body_of(
                    F.when(ends_with_as, after_as).otherwise(F.col("_tail")), F.col("_kind")
                ),
            ),
        ),
        ("_body_due", body_due),
        ("_reason", reason),
    ]


@built_once
def _group_columns() -> list[tuple[str, Column]]:
    """Language and the four option groups; a group nothing was given for is null."""
    outline = F.col("_outlined.outline")
    written = F.upper(
        F.regexp_extract(outline, r"(?i)(?:\A|[\s)>])LANGUAGE\s+([^\s()<>;]+)", 1)
    )
    language = F.when(written == "", "SQL").when(written == "JS", "JAVASCRIPT").otherwise(written)
    # In the outline each bracket group is empty, so these words can only be the clauses.
    part = r"(?:`[^`]*`|[\w@$]+)"
    connection = (
        rf"(?i)(?:\A|[\s)>]){{}}WITH\s+CONNECTION\s+({part}(?:\s*\.\s*{part})*)"
    )

    def connection_of(before: str) -> Column:
        found = F.regexp_extract(outline, connection.format(before), 1)
        return values.null_if_empty(F.regexp_replace(found, r"[`\s]", ""))

    routine = ~F.col("_is_view")
    is_proc = F.col("_kind") == "PROCEDURE"
    is_python = F.col("language") == "PYTHON"
    python_like = ~is_proc & (is_python | F.col("_entry_point").isNotNull())
    engine_spark = F.coalesce(F.upper(_unquoted("engine")), F.lit("")) == "SPARK"
    external_version = ~is_proc & (~engine_spark | is_python)
    rows = _unquoted("max_batching_rows")
    context = values.pair_map(_option("user_defined_context"))
    uri_lists = ("py_file_uris", "jar_uris", "file_uris", "archive_uris")

    remote = F.struct(
        F.col("_remote_conn").alias("connection"),
        _text("endpoint").alias("endpoint"),
        F.when(~python_like, rows).alias("max_batching_rows"),
        context.alias("user_defined_context"),
    )
    has_remote = (
        F.col("_remote_conn").isNotNull()
        | _text("endpoint").isNotNull()
        | (~python_like & rows.isNotNull())
        | F.coalesce(F.size(context) > 0, F.lit(False))
    )
    external = F.struct(
        _unquoted("container_memory").alias("container_memory"),
        _unquoted("container_cpu").alias("container_cpu"),
        F.when(~is_proc, F.col("_conn")).alias("runtime_connection"),
        F.when(python_like, rows).alias("max_batching_rows"),
        F.when(external_version, _unquoted("runtime_version")).alias("runtime_version"),
        _unquoted("container_request_concurrency").alias("container_request_concurrency"),
    )
    has_external = (
        _given("container_memory", "container_cpu", "container_request_concurrency")
        | (~is_proc & F.col("_conn").isNotNull())
        | (python_like & rows.isNotNull())
        | (external_version & _given("runtime_version"))
    )
    spark = F.struct(
        F.col("_conn").alias("connection"),
        *[
            _unquoted(o).alias(o)
            for o in ("runtime_version", "container_image", "main_file_uri", "main_class")
        ],
        *[values.string_list(_option(o)).alias(o) for o in uri_lists],
        values.pair_map(_option("properties")).alias("properties"),
    )
    has_spark = F.col("_conn").isNotNull() | _given(
        "runtime_version", "container_image", "main_file_uri", "main_class", "properties",
        *uri_lists,
    )
    python = F.struct(
        F.col("_entry_point").alias("entry_point"),
        values.string_list(_option("packages")).alias("packages"),
    )
    return [
        ("language", F.when(routine, language)),
        ("_remote_conn", connection_of(r"REMOTE\s+")),
        ("_conn", connection_of(r"(?<!REMOTE\s)")),
        ("_entry_point", _unquoted("entry_point")),
        ("remote_function_options", F.when(routine & has_remote, remote)),
        ("spark_options", F.when(is_proc & has_spark, spark)),
        ("python_options", F.when(routine & _given("entry_point", "packages"), python)),
        ("external_runtime_options", F.when(routine & has_external, external)),
        ("_returns", F.when(routine, headers.returned_type(outline, F.col("_outlined.items")))),
        ("_returns_json", values.type_json(F.col("_returns"))),
    ]


# The columns of the catalog, in the order of ``_result_columns``.
CATALOG_COLUMNS = (
    "script_id", "kind", "project", "dataset_id", "object_id", "reference_id", "resource_id",
    "language", "body", "description", "friendly_name", "labels", "is_materialized",
    "determinism_level", "data_governance_type", "imported_libraries", "enable_refresh",
    "allow_non_incremental_definition", "refresh_interval_ms", "max_staleness", "kms_key_name",
    "partitioning_type", "partitioning_field", "clustering", "arguments", "view_columns",
    "return_type", "return_table_type", "return_type_json", "return_table_type_json", "schema_json",
    "remote_function_options", "spark_options", "python_options", "external_runtime_options",
    "options",
)


def _result_columns(trim_body: bool, trim_comments: bool, trim_indentation: bool) -> list[Column]:
    outline, items = F.col("_outlined.outline"), F.col("_outlined.items")
    is_view, kind = F.col("_is_view"), F.col("_kind")
    dataset, obj, project = F.col("_id.dataset_id"), F.col("_id.object_id"), F.col("_id.project")
    returns_table = F.col("_returns").startswith("TABLE")
    no_strings = F.array().cast(_LIST)

    partition = F.regexp_extract(outline, headers.VIEW_OUTLINE, 1)
    partition_call = F.filter(items, lambda i: (i["open"] == "(") & ~i["lead"].isin("", "OPTIONS"))
    call_field = F.regexp_extract(
        F.get(partition_call, F.lit(0))["text"], rf"\A(`[^`]*`|{lexis.WORD}|\S)", 1
    )
    is_call = F.regexp_extract(outline, headers.VIEW_OUTLINE, 2) != ""
    field = values.bare_name(F.when(is_call, call_field).otherwise(partition))
    clustering = F.regexp_extract(outline, headers.VIEW_OUTLINE, 3)
    parts = F.col("_item_parts")
    libraries = F.concat(
        F.coalesce(values.string_list(_option("library")), no_strings),
        F.coalesce(values.string_list(_option("libraries")), no_strings),
    )
    labels = F.coalesce(
        values.pair_map(_option("labels")), F.map_from_arrays(no_strings, no_strings)
    )
    body = clean_body(
        F.when(F.col("_body_due"), F.col("_raw_body")).otherwise(F.lit("")),
        trim_body,
        trim_comments,
        trim_indentation,
    )
    staleness = values.null_if_empty(values.normalize_interval(_option("max_staleness")))

    def views(value: Column) -> Column:
        return F.when(is_view, value)

    def routines(value: Column) -> Column:
        return F.when(~is_view, value)

    return [
        F.col("script_id"),
        kind.alias("kind"),
        project.alias("project"),
        dataset.alias("dataset_id"),
        obj.alias("object_id"),
        headers.reference_id(dataset, obj).alias("reference_id"),
        headers.resource_id(kind, project, dataset, obj).alias("resource_id"),
        F.col("language"),
        body.alias("body"),
        _text("description").alias("description"),
        views(_text("friendly_name")).alias("friendly_name"),
        views(labels).alias("labels"),
        (kind == "MATERIALIZED_VIEW").alias("is_materialized"),
        routines(F.upper(_text("determinism_level"))).alias("determinism_level"),
        routines(F.upper(_text("data_governance_type"))).alias("data_governance_type"),
        routines(libraries).alias("imported_libraries"),
        views(values.truth(_option("enable_refresh"))).alias("enable_refresh"),
        views(values.truth(_option("allow_non_incremental_definition"))).alias(
            "allow_non_incremental_definition"
        ),
        views(values.minutes_to_millis(_option("refresh_interval_minutes"))).alias(
            "refresh_interval_ms"
        ),
        views(staleness).alias("max_staleness"),
        views(_text("kms_key_name")).alias("kms_key_name"),
        F.when(is_view & (partition != ""), "DAY").alias("partitioning_type"),
        views(values.null_if_empty(field)).alias("partitioning_field"),
        F.when(
            is_view & (clustering != ""),
            F.transform(F.split(clustering, ","), lambda c: values.bare_name(trim_edges(c))),
        ).alias("clustering"),
        routines(F.transform(parts, lambda p: headers.argument(p, kind))).alias("arguments"),
        views(F.transform(parts, headers.view_column)).alias("view_columns"),
        F.when(~returns_table, F.col("_returns")).alias("return_type"),
        F.when(returns_table, F.col("_returns")).alias("return_table_type"),
        F.when(~returns_table, F.col("_returns_json")).alias("return_type_json"),
        values.table_columns_json(F.col("_returns_json")).alias("return_table_type_json"),
        views(headers.schema_json(F.transform(parts, headers.view_column))).alias("schema_json"),
        F.col("remote_function_options"),
        F.col("spark_options"),
        F.col("python_options"),
        F.col("external_runtime_options"),
        F.col("_options").alias("options"),
    ]


def _staged(scripts: DataFrame) -> DataFrame:
    return with_each(with_each(scripts, _header_columns()), _stage_columns())


def _reason(family: str | None) -> Column:
    is_view = F.col("_kind").isin(*headers.VIEW_KINDS)
    if family == ROUTINE:
        return F.coalesce(F.col("_reason"), F.when(is_view, "not a routine"))
    if family == VIEW:
        return F.coalesce(F.col("_reason"), F.when(~is_view, "not a view"))
    return F.col("_reason")


def _may_be(family: str | None) -> Column:
    """False or null for scripts that are rejected, or of the other family, whatever follows the kind."""
    is_view = F.col("_kind").isin(*headers.VIEW_KINDS)
    wanted = {ROUTINE: ~is_view, VIEW: is_view}.get(family, F.col("_kind").isNotNull())
    return wanted & ((F.col("_tail") == "") | (F.col("_ender") != ""))


def classify(scripts: DataFrame) -> DataFrame:
    """Script ids with the kind of object each creates; null for any other statement."""
    return sealed(
        with_each(scripts, _header_columns()).select("script_id", F.col("_kind").alias("kind"))
    )


_RESULTS: dict[tuple, object] = {}


def _result_list(*flags: bool) -> list[Column]:
    if flags not in _RESULTS:
        _RESULTS[flags] = built_once(lambda: [("", c) for c in _result_columns(*flags)])
    return [c for _, c in _RESULTS[flags]()]


def catalog(
    scripts: DataFrame,
    family: str | None = None,
    trim_body: bool = True,
    trim_comments: bool = False,
    trim_indentation: bool = True,
) -> DataFrame:
    """One row per accepted script. ``family`` is ``"routine"``, ``"view"`` or none for both."""
    return sealed(
        catalog_rows(scripts, family, trim_body, trim_comments, trim_indentation)
    )


def catalog_rows(
    scripts: DataFrame,
    family: str | None = None,
    trim_body: bool = True,
    trim_comments: bool = False,
    trim_indentation: bool = True,
) -> DataFrame:
    """``catalog`` for further projections only: columns not used are not computed, but a filter
    or join on the result would be moved into the projections."""
    results = _result_list(trim_body, trim_comments, trim_indentation)
    # what the header alone rules out is dropped before it is worked on
    likely = keep_where(with_each(scripts, _header_columns()), _may_be(family))
    accepted = keep_where(with_each(likely, _stage_columns()), F.col("_reason").isNull())
    return with_each(accepted, _group_columns()).select(*results)


REJECT_COLUMNS = ("script_id", "reason", "offset", "line", "column")
_AFTER_HEADER = ("bad character or open quote", "malformed header", "no body", "unclosed body")


@built_once
def _place_columns() -> list[tuple[str, Column]]:
    """Where reading stopped, for rows with a ``reason``; null for those without."""
    reason, written = F.col("reason"), F.coalesce(F.col("sql"), F.lit(""))
    named = F.regexp_extract("_header", headers.CREATE_KIND, 0)
    # a body's first sign: the paren, quote or BEGIN that is not closed, or where it is missing
    after_as = F.substring(F.col("_tail"), F.lit(3), F.length("_tail"))
    gap = F.length(after_as) - F.length(F.ltrim(after_as, F.lit(" \t\n\r")))
    body_at = F.length("_header") + F.when(F.col("_ender") == "AS", 2 + gap).otherwise(0)
    at = (
        F.when(reason == "empty script", 0)
        .when(reason.isin("no body", "unclosed body"), body_at)
        .when(
            (reason == "malformed header") & (F.col("_outlined.depth") != 0),
            F.length(F.regexp_extract("_header", headers.CREATE_NAME, 0)) + F.col("_outlined.mark"),
        )
        .when(reason.isin(*_AFTER_HEADER), F.length("_header"))
        .when(reason == "no object name", F.length(named))
        .when(reason.isNotNull(), F.length(F.regexp_extract("_header", headers.LEADING_GAP, 0)))
    )
    # a trimmed script begins with no space, so it is first found where it was cut out
    before = F.when(F.col("_sql") == "", 0).otherwise(F.instr(written, F.col("_sql")) - 1)
    passed = F.substring(written, F.lit(1), F.col("offset"))
    line_ends = F.length(passed) - F.length(F.replace(passed, F.lit("\n"), F.lit("")))
    in_line = F.length(F.substring_index(passed, "\n", -1))
    return [
        ("offset", (before + at).cast("bigint")),
        ("line", (line_ends + 1).cast("bigint")),
        ("column", (in_line + 1).cast("bigint")),
    ]


def rejects(scripts: DataFrame, family: str | None = None) -> DataFrame:
    """``script_id``, ``reason``, ``offset``, ``line`` and ``column`` of the scripts that ``catalog`` leaves out.

    ``offset`` counts the characters before the place where reading stopped, ``line`` and ``column`` are
    its own from 1. The place is the sign that fits nowhere, the first sign of a body that is not closed
    or where a body is missing, the outermost bracket of a header that is not closed or not open, the end of
    the header for what else is wrong in it, the end of the kind where the name is missing, else the
    statement's first word.
    """
    checked = _staged(scripts).withColumn("reason", _reason(family))
    kept = keep_where(checked, F.col("reason").isNotNull())
    return sealed(with_each(kept, _place_columns()).select(*REJECT_COLUMNS))


def checked_rows(
    scripts: DataFrame,
    family: str | None = None,
    trim_body: bool = True,
    trim_comments: bool = False,
    trim_indentation: bool = True,
) -> DataFrame:
    """Accepted and rejected scripts in one pass, for a stage table that is split afterwards.

    The columns of ``catalog_rows`` with ``reason`` and its place. A rejected script has
    only these and its id; an accepted one has nulls in them.
    """
    checked = _staged(scripts).withColumn("reason", _reason(family))
    results = _result_list(trim_body, trim_comments, trim_indentation)
    # one by one and not as one struct, so that columns not used further on are not computed
    accepted = [
        F.when(F.col("reason").isNull(), column).alias(name)
        for name, column in zip(CATALOG_COLUMNS, results, strict=True)
    ][1:]
    return with_each(with_each(checked, _place_columns()), _group_columns()).select(*REJECT_COLUMNS, *accepted)
