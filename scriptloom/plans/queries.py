"""One query per operator over the benchmark tables: whole tables, whole texts."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptloom.functions import header as headers
from scriptloom.functions import references as refs
from scriptloom.functions import text, values
from scriptloom.operators import catalog as cat
from scriptloom.operators import children, layering, outputs
from scriptloom.operators import references as ref_ops
from scriptloom.plans.lineage import creation_order, lineage
from scriptloom.session import checkpoint_dir, stage_table
from scriptloom.sources import corpora, scripts
from scriptloom.streaming import catalogs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TARGET = "env-proj"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def _homeless(bodies: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return bodies.withColumns({"dataset_id": nothing, "object_id": nothing})


def _rows(spark: SparkSession, sf_dir: str, family: str | None = None, **flags) -> DataFrame:
    return cat.catalog_rows(corpora.order_scripts(spark, sf_dir), family, **flags)


# --- clean-up ---------------------------------------------------------------------------------


@query
def trim_edges(spark, sf_dir):
    padded = F.concat(F.lit(" \n \t"), "body", F.lit("\r\n　 \n"))
    return corpora.free_text(spark, sf_dir).select(
        "script_id", text.trim_edges(padded).alias("body")
    )


@query
def dedent(spark, sf_dir):
    return corpora.order_bodies(spark, sf_dir).select(
        "script_id", text.dedent(F.col("body")).alias("body")
    )


@query
def strip_comments(spark, sf_dir):
    return corpora.free_text(spark, sf_dir).select(
        "script_id", text.strip_comments(F.col("body")).alias("body")
    )


@query
def clean_body(spark, sf_dir):
    return corpora.order_bodies(spark, sf_dir).select(
        "script_id", text.clean_body(F.col("body"), trim_comments=True).alias("body")
    )


@query
def placeholder_substitution(spark, sf_dir):
    return corpora.order_bodies(spark, sf_dir, corpora.PLACEHOLDERS_SQL).select(
        "script_id", text.fill_project(F.col("body"), F.col("project")).alias("body")
    )


# --- catalog ----------------------------------------------------------------------------------


@query
def load_table(spark, sf_dir):
    documents = corpora.read_table(spark, sf_dir, "documents")
    return scripts.as_scripts(documents, "doc_id", "text")


@query
def load_scripts(spark, sf_dir):
    """A file per nation, in a folder of its own, loaded back from the folders."""
    nation = corpora.read_table(spark, sf_dir, "nation")
    view = F.concat(F.lit("CREATE VIEW ds.n"), "n_nationkey", F.lit(" AS SELECT '"), "n_name", F.lit("'"))
    path = f"{checkpoint_dir(spark)}/scripts-{uuid.uuid4().hex}"
    nation.select("n_nationkey", view.alias("sql")).write.partitionBy("n_nationkey").text(path)
    return scripts.load_scripts(spark, f"{path}/*/*.txt").select(
        F.regexp_extract("script_id", r"\An_nationkey=(\d+)/", 1).alias("folder"), "sql"
    )


@query
def classify(spark, sf_dir):
    return cat.classify(corpora.order_scripts(spark, sf_dir))


@query
def rejects(spark, sf_dir):
    return cat.rejects(corpora.order_scripts(spark, sf_dir))


@query
def rejects_routine_family(spark, sf_dir):
    return cat.rejects(corpora.order_scripts(spark, sf_dir), cat.ROUTINE)


@query
def accepted_views(spark, sf_dir):
    return _rows(spark, sf_dir, cat.VIEW).select("script_id", "kind", "is_materialized")


@query
def free_text_rejects(spark, sf_dir):
    bodies = corpora.free_text(spark, sf_dir)
    return cat.rejects(bodies.withColumnRenamed("body", "sql")).select("script_id")


@query
def qualified_names(spark, sf_dir):
    return _rows(spark, sf_dir).select("script_id", "project", "dataset_id", "object_id")


@query
def object_ids(spark, sf_dir):
    return _rows(spark, sf_dir).select(
        "script_id",
        "reference_id",
        "resource_id",
        headers.resource_type(F.col("kind")).alias("resource_type"),
    )


@query
def language(spark, sf_dir):
    return _rows(spark, sf_dir, cat.ROUTINE).select("script_id", "language")


@query
def body_span(spark, sf_dir):
    return _rows(spark, sf_dir, trim_body=False, trim_indentation=False).select(
        "script_id", "body"
    )


@query
def partitioning(spark, sf_dir):
    return _rows(spark, sf_dir, cat.VIEW).select(
        "script_id", "partitioning_type", "partitioning_field"
    )


@query
def clustering(spark, sf_dir):
    return children.clustering(_rows(spark, sf_dir, cat.VIEW))


@query
def view_settings(spark, sf_dir):
    return _rows(spark, sf_dir, cat.VIEW).select(
        "script_id", "enable_refresh", "allow_non_incremental_definition", "refresh_interval_ms",
        "max_staleness", "kms_key_name",
    )


@query
def text_options(spark, sf_dir):
    return _rows(spark, sf_dir).select(
        "script_id", "description", "friendly_name", "determinism_level", "data_governance_type"
    )


@query
def interval_values(spark, sf_dir):
    lines = corpora.read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    units = F.array(*[F.lit(u) for u in ("HOUR", "minutes", "SECOND", "DAYS", "Month", "YEAR")])
    unit = F.get(units, (F.col("l_linenumber") % 6).cast("int"))
    written = F.concat(F.lit(" interval "), F.col("l_orderkey"), F.lit(" "), unit)
    return lines.select(
        F.col("l_orderkey"),
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        values.normalize_interval(written).alias("interval_value"),
    )


@query
def return_types(spark, sf_dir):
    return _rows(spark, sf_dir, cat.ROUTINE).select(
        "script_id", "return_type", "return_table_type"
    )


# --- child tables -----------------------------------------------------------------------------


@query
def routine_arguments(spark, sf_dir):
    return children.arguments(_rows(spark, sf_dir, cat.ROUTINE)).drop("data_type_json")


@query
def argument_types(spark, sf_dir):
    """The types of arguments, of what routines return and of view columns, as JSON trees."""
    rows = _rows(spark, sf_dir).select(
        "script_id", "arguments", "return_type_json", "return_table_type_json", "schema_json"
    )
    given = F.transform(
        "arguments", lambda a: F.struct(a["name"].alias("place"), a["data_type_json"].alias("tree"))
    )
    whole = F.array(*[
        F.struct(F.lit(place).alias("place"), F.col(column).alias("tree"))
        for place, column in (
            ("(return)", "return_type_json"),
            ("(table)", "return_table_type_json"),
            ("(schema)", "schema_json"),
        )
    ])
    none = F.array().cast("array<struct<place:string,tree:string>>")
    trees = F.filter(F.concat(F.coalesce(given, none), whole), lambda e: e["tree"].isNotNull())
    return rows.select("script_id", F.inline(trees))


@query
def view_columns(spark, sf_dir):
    return children.view_columns(_rows(spark, sf_dir, cat.VIEW))


@query
def options_table(spark, sf_dir):
    return children.options(_rows(spark, sf_dir))


@query
def list_options(spark, sf_dir):
    return children.list_options(_rows(spark, sf_dir, cat.ROUTINE))


@query
def pair_options(spark, sf_dir):
    return children.pair_options(_rows(spark, sf_dir))


@query
def option_groups(spark, sf_dir):
    rows = _rows(spark, sf_dir, cat.ROUTINE)
    spark_col, external = F.col("spark_options"), F.col("external_runtime_options")
    remote, python = F.col("remote_function_options"), F.col("python_options")
    return rows.select(
        "script_id",
        remote["endpoint"].alias("endpoint"),
        remote["max_batching_rows"].alias("remote_rows"),
        spark_col["runtime_version"].alias("spark_version"),
        spark_col["main_file_uri"].alias("main_file_uri"),
        python["entry_point"].alias("entry_point"),
        external["runtime_version"].alias("external_version"),
        external["max_batching_rows"].alias("external_rows"),
        external["container_cpu"].alias("container_cpu"),
        remote.isNull().alias("no_remote"),
        spark_col.isNull().alias("no_spark"),
        python.isNull().alias("no_python"),
        external.isNull().alias("no_external"),
    )


@query
def connections(spark, sf_dir):
    return _rows(spark, sf_dir, cat.ROUTINE).select(
        "script_id",
        F.col("remote_function_options.connection").alias("remote_connection"),
        F.col("spark_options.connection").alias("spark_connection"),
        F.col("external_runtime_options.runtime_connection").alias("external_connection"),
    )


# --- references -------------------------------------------------------------------------------


@query
def body_tokens(spark, sf_dir):
    return ref_ops.body_tokens(corpora.order_bodies(spark, sf_dir))


@query
def free_text_tokens(spark, sf_dir):
    return ref_ops.body_tokens(corpora.free_text(spark, sf_dir))


@query
def free_text_names(spark, sf_dir):
    return ref_ops.body_names(corpora.free_text(spark, sf_dir))


@query
def script_names(spark, sf_dir):
    return ref_ops.body_names(_rows(spark, sf_dir))


@query
def references(spark, sf_dir):
    return ref_ops.refs_table(ref_ops.reference_rows(_rows(spark, sf_dir)))


@query
def foreign_datasets(spark, sf_dir):
    return ref_ops.dataset_refs_table(ref_ops.reference_rows(_rows(spark, sf_dir)))


@query
def homeless_foreign_datasets(spark, sf_dir):
    bodies = _homeless(corpora.order_bodies(spark, sf_dir))
    return ref_ops.dataset_refs_table(ref_ops.reference_rows(bodies))


@query
def qualified_bodies(spark, sf_dir):
    return ref_ops.qualify(_rows(spark, sf_dir), TARGET).select("script_id", "body")


@query
def inferred_project_bodies(spark, sf_dir):
    return ref_ops.qualify(_rows(spark, sf_dir, cat.ROUTINE)).select("script_id", "body")


# --- layering ---------------------------------------------------------------------------------

GRAPHS = {
    "chain": (corpora.CHAIN_NODES_SQL, corpora.CHAIN_EDGES_SQL),
    "turns": (corpora.TURN_NODES_SQL, corpora.TURN_EDGES_SQL),
    "star": (corpora.STAR_NODES_SQL, corpora.STAR_EDGES_SQL),
    "hot": (corpora.HOT_NODES_SQL, corpora.HOT_EDGES_SQL),
}


def _graph(spark, sf_dir, name: str) -> tuple[DataFrame, DataFrame]:
    nodes, edges = GRAPHS[name]
    return corpora.from_tables(spark, sf_dir, nodes), corpora.from_tables(spark, sf_dir, edges)


@query
def layers_chain(spark, sf_dir):
    return layering.compute_layers(*_graph(spark, sf_dir, "chain")).ordered()


@query
def layers_turns(spark, sf_dir):
    return layering.compute_layers(*_graph(spark, sf_dir, "turns")).ordered()


@query
def layers_star(spark, sf_dir):
    return layering.compute_layers(*_graph(spark, sf_dir, "star")).ordered()


@query
def layers_star_salted(spark, sf_dir):
    """The same layers with only the heaviest dependencies (above a twentieth of all edges) kept apart."""
    graph = _graph(spark, sf_dir, "star")
    return layering.compute_layers(*graph, heavy_most=20).ordered()


@query
def layers_hot(spark, sf_dir):
    """One object is what more than a third of all edges point at."""
    return layering.compute_layers(*_graph(spark, sf_dir, "hot")).ordered()


@query
def layer_depth(spark, sf_dir):
    return layering.compute_layers(*_graph(spark, sf_dir, "turns")).depth()


@query
def duplicate_nodes(spark, sf_dir):
    lines = corpora.read_table(spark, sf_dir, "lineitem")
    return layering.duplicate_nodes(
        lines.select(
            F.lit("lineitem").alias("dataset_id"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("object_id"),
        )
    )


@query
def managed_edges(spark, sf_dir):
    edges = layering.managed_edges(*_script_graph(spark, sf_dir))
    return edges.select(
        F.replace("src", F.lit("\0"), F.lit(".")).alias("src"),
        F.replace("dep", F.lit("\0"), F.lit(".")).alias("dep"),
    )


@query
def indegrees(spark, sf_dir):
    return layering.indegrees(*_script_graph(spark, sf_dir))


def _script_graph(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    objects = ref_ops.reference_rows(_rows(spark, sf_dir)).select(
        "dataset_id", "object_id", F.col("kind").alias("object_type"), "references"
    )
    return scripts.graph_of(stage_table(objects))


@query
def cycle_members(spark, sf_dir):
    """What the cycle error lists when each second turn of a conversation points forward too."""
    nodes, edges = _graph(spark, sf_dir, "turns")
    forward = edges.filter("src_object = 't3'").select(
        F.col("dep_dataset").alias("src_dataset"),
        F.col("dep_object").alias("src_object"),
        F.col("src_dataset").alias("dep_dataset"),
        F.col("src_object").alias("dep_object"),
        "dep_type",
    )
    try:
        layering.compute_layers(nodes, edges.unionByName(forward))
    except layering.CyclicDependencyError as error:
        return error.remaining
    return nodes.limit(0).select(F.col("object_id").alias("reference_id"))


@query
def creation_layers(spark, sf_dir):
    """Flagship: scripts to references to creation order."""
    return creation_order(corpora.order_scripts(spark, sf_dir)).ordered()


@query
def blank_ids(spark, sf_dir):
    """Customers as nodes; three of four have white space for an object id."""
    key = F.col("c_custkey")
    object_id = (
        F.when(key % 4 == 0, F.lit("\t")).when(key % 4 == 1, F.lit(" \n"))
        .when(key % 4 == 2, F.concat(F.lit("o"), key.cast("string"))).otherwise(F.lit("\u3000"))
    )
    nodes = corpora.read_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("d"), key.cast("string")).alias("dataset_id"), object_id.alias("object_id")
    )
    return layering.blank_nodes(nodes)


@query
def lineage_rejects(spark, sf_dir):
    """Scripts that the lineage leaves out, as it returns them."""
    return lineage(corpora.order_scripts(spark, sf_dir), TARGET).rejects


@query
def huge_intervals(spark, sf_dir):
    """Intervals whose seconds fit no 64-bit number stay as written, next to ones that fit."""
    orders = corpora.read_table(spark, sf_dir, "orders")
    number = F.when(F.col("o_orderkey") % 2 == 0, F.lit("9223372036854775807")).otherwise("3")
    value = F.concat(F.lit("INTERVAL "), number, F.lit(" HOUR"))
    return orders.select("o_orderkey", values.normalize_interval(value).alias("normalized"))


@query
def creation_stages(spark, sf_dir):
    """Stages written one folder per layer and read back."""
    result = lineage(corpora.order_scripts(spark, sf_dir), TARGET)
    staged = outputs.stages(result.layering.layers, result.objects).select(
        "reference_id", "script_id", "kind", "layer"
    )
    path = f"{checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    outputs.write_stages(staged, path)
    return spark.read.parquet(path).select(
        "reference_id", "script_id", "kind", F.col("layer").cast("bigint").alias("layer")
    )


@query
def access_grants(spark, sf_dir):
    return outputs.grants(ref_ops.reference_rows(_rows(spark, sf_dir)))


@query
def creation_stages_again(spark, sf_dir):
    """Every second layer written again over the stages of the first one alone."""
    result = creation_order(corpora.order_scripts(spark, sf_dir))
    staged = result.layering.layers.select("layer", "dataset_id", "object_id", "reference_id")
    path = f"{checkpoint_dir(spark)}/stages-{uuid.uuid4().hex}"
    outputs.write_stages(staged.withColumn("run", F.lit(1)), path)
    outputs.write_stages(staged.where("layer % 2 = 0").withColumn("run", F.lit(2)), path, partial=True)
    return spark.read.parquet(path).select("reference_id", F.col("layer").cast("bigint").alias("layer"), "run")


@query
def order_rejects(spark, sf_dir):
    """Scripts that the creation order leaves out, as it returns them."""
    return creation_order(corpora.order_scripts(spark, sf_dir)).rejects


@query
def repeated_scripts(spark, sf_dir):
    """Conversations taken for scripts, one row per turn."""
    turns = corpora.read_table(spark, sf_dir, "conversations")
    return scripts.repeated_ids(scripts.as_scripts(turns, "conv_id", "text"))


def _followed(spark, sf_dir):
    """The corpus as a stream of files, each script twice, taken in by several batches."""
    corpus = corpora.order_scripts(spark, sf_dir)
    folder = f"{checkpoint_dir(spark)}/followed-{uuid.uuid4().hex}"
    # a file a task, so files grow in number with the corpus; a batch takes three eighths of them
    corpus.write.parquet(f"{folder}/in")
    corpus.write.mode("append").parquet(f"{folder}/in")
    at_once = math.ceil(len(spark.read.parquet(f"{folder}/in").inputFiles()) * 3 / 8)
    files = spark.readStream.schema(corpus.schema).option("maxFilesPerTrigger", at_once).parquet(f"{folder}/in")
    catalogs.follow(files, f"{folder}/out", f"{folder}/state", once=True).awaitTermination()
    return catalogs.followed(spark, f"{folder}/out")


@query
def followed_objects(spark, sf_dir):
    return _followed(spark, sf_dir)[0].select("script_id", "kind", "dataset_id", "object_id")


@query
def followed_rejects(spark, sf_dir):
    return _followed(spark, sf_dir)[1]


@query
def mixed_names(spark, sf_dir):
    """Names of bodies with nested EXTRACT, MERGE and USING, lists with aliases, joined names and calls."""
    return ref_ops.body_names(corpora.mixed_bodies(spark, sf_dir))


@query
def mixed_blocks(spark, sf_dir):
    """Bodies of procedures whose statements are nested three deep."""
    rows = cat.catalog(corpora.mixed_scripts(spark, sf_dir), trim_body=False, trim_indentation=False)
    return rows.select("script_id", "body")


@query
def mixed_arguments(spark, sf_dir):
    rows = cat.catalog_rows(corpora.mixed_scripts(spark, sf_dir))
    return children.arguments(rows).select("script_id", "position", "name", "mode", "data_type")
