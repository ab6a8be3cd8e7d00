"""References between objects, and bodies rewritten with a target project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.functions import references as refs
from scriptloom.functions.binding import built_once, elements, sealed, with_each
from scriptloom.functions.header import VIEW_KINDS
from scriptloom.functions.text import fill_project


@built_once
def _name_columns() -> list[tuple[str, Column]]:
    # A kept name has a dot; where the body has none, its tokens need not be gone through.
    searched = F.when(F.contains("body", F.lit(".")), F.col("_tokens")).when(
        F.col("body").isNotNull(), F.array().cast("array<string>")
    )
    return [
        ("_tokens", refs.name_tokens(F.col("body"))),
        ("_names", refs.located(refs.kept_names(searched))),
    ]


@built_once
def _reference_columns() -> list[tuple[str, Column]]:
    home, obj = F.col("dataset_id"), F.col("object_id")
    return [
        ("dataset_references", refs.foreign_datasets(F.col("_names"), home)),
        ("references", refs.first_uses(refs.without_self(F.col("_names"), home, obj))),
    ]


@built_once
def _rewrite_columns() -> list[tuple[str, Column]]:
    rewritten = refs.with_project(
        F.col("_pieces"), F.col("_tokens"), F.col("_names"), F.col("dataset_id"), F.col("_project")
    )
    return [
        ("_pieces", F.when(F.col("_rewrite"), refs.name_pieces(F.col("body")))),
        ("body", F.when(F.col("_rewrite"), rewritten).otherwise(F.col("body"))),
    ]


def _finished(df: DataFrame) -> DataFrame:
    return df.drop("_tokens", "_names", "_pieces", "_project", "_rewrite")


def reference_rows(bodies: DataFrame) -> DataFrame:
    """``with_references`` for further projections only; see ``catalog_rows``."""
    return _finished(with_each(with_each(bodies, _name_columns()), _reference_columns()))


def with_references(bodies: DataFrame) -> DataFrame:
    """Add ``dataset_references`` and ``references`` to rows with ``body``, ``dataset_id`` and
    ``object_id`` (the script's own, null where not known)."""
    return sealed(reference_rows(bodies))


def qualify(catalog: DataFrame, target_project: str | Column | None = None) -> DataFrame:
    """Add the references, and put the target project into the routine bodies.

    The project is ``target_project``, or where that is null the project in the object's own name.
    An empty text is a choice too: it turns rewriting off. Views keep their text.
    """
    own = F.col("project")
    if target_project is None:
        project = own
    elif isinstance(target_project, Column):
        project = F.coalesce(target_project, own)
    else:
        project = F.lit(target_project)
    project = F.coalesce(project, F.lit(""))
    rewrite = ~F.col("kind").isin(*VIEW_KINDS) & (project != "")
    df = catalog.withColumns({"_project": project, "_rewrite": rewrite})
    df = df.withColumn(
        "body",
        F.when(F.col("_rewrite"), fill_project(F.col("body"), F.col("_project"))).otherwise(
            F.col("body")
        ),
    )
    df = with_each(with_each(df, _name_columns()), _reference_columns())
    return sealed(_finished(with_each(df, _rewrite_columns())))


def refs_table(with_refs: DataFrame) -> DataFrame:
    """The edge table: one row per script and referenced object."""
    return with_refs.select("script_id", F.inline(elements(F.col("references"))))


def dataset_refs_table(with_refs: DataFrame) -> DataFrame:
    """One row per script and foreign dataset."""
    return with_refs.select("script_id", F.explode(elements(F.col("dataset_references"))).alias("dataset_id"))


def body_names(bodies: DataFrame) -> DataFrame:
    """Every kept name of every body, in the order of the text, repeats included."""
    return with_each(bodies, _name_columns()).select(
        "script_id", F.posexplode(elements(F.col("_names"))).alias("pos", "name")
    ).select(
        "script_id",
        (F.col("pos") + 1).cast("bigint").alias("position"),
        "name.dataset_id",
        "name.object_id",
        "name.object_type",
        "name.has_project",
        "name.metadata",
    )


def body_tokens(bodies: DataFrame) -> DataFrame:
    """The token table of the bodies: ``script_id``, ``position``, ``token``, without gaps."""
    tokens = F.filter(refs.body_tokens(F.col("body")), lambda t: t != "")
    return bodies.select("script_id", F.posexplode(elements(tokens)).alias("pos", "token")).select(
        "script_id", (F.col("pos") + 1).cast("bigint").alias("position"), "token"
    )
