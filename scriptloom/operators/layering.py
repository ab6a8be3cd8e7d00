"""Creation order of a dependency graph: objects in layers, each after all it depends on.

A node's layer is one more than the highest layer among its dependencies. Rounds start from the nodes
that depend on nothing. Every round takes the nodes that were settled last, follows the edges that
lead to them, and tells each source how many of its dependencies are settled now and how high they
lie; a source with none left is settled in its turn. So every edge is followed once.

Edges lie in buckets by dependency and nodes in buckets by key, so a round exchanges nothing but its
own messages, added up before they leave a task, and what was told before to nodes that wait for more.
It writes the nodes that were told anything; the others are read and stay as they lie. Neither edges nor
nodes are sorted: the nodes settled last are the hashed side of the join, broadcast where they are few.
The driver gets counts only.

Chains. An edge between a node with one dependency and a node with one dependent is a link; links form
paths. Pointers along paths are followed ever further until they reach the path's first node. From
then on the path is settled with that node, and its last node speaks in the same round. A chain of n
objects takes about log n jobs, whatever hangs on it.

Hot dependencies. One object may be what a third of all edges point at. A frequency sketch, taken
while the edges are written, names the dependencies with more than about 1/1000 of all edges. They
are fewer than ``HEAVY_MOST``, so what is known about them can be broadcast at any size; their edges are
never dealt by dependency. Hot sources need nothing: messages are added up before the exchange.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptloom.functions.header import reference_id, resource_type
from scriptloom.functions.references import METADATA_SCHEMA
from scriptloom.functions.text import trim_edges
from scriptloom.session import bucket_count, bucketed_stage, counted_stage, stage_table

HEAVY_MOST = 1000  # dependencies whose edges are kept apart, at most
TRACKED = 20_000  # entries of the frequency sketch
HOPS_PER_JOB = 3
BROADCAST_MOST = 100_000  # nodes that are sent to all tasks, at most
HASHED_MOST = 1_000_000  # nodes of a bucket that are held by a task, at most


class LayeringError(ValueError):
    """The graph cannot be layered."""


class BlankIdError(LayeringError):
    pass


class DuplicateObjectError(LayeringError):
    pass


class CyclicDependencyError(LayeringError):
    """``remaining`` holds every object on a cycle or downstream of one, sorted."""

    def __init__(self, message: str, remaining: DataFrame):
        super().__init__(message)
        self.remaining = remaining


@dataclass(frozen=True)
class Layering:
    """``layers`` is unsorted and written to a stage table; ``jobs`` is the number of jobs the
    rounds took."""

    layers: DataFrame
    jobs: int

    def ordered(self) -> DataFrame:
        """Sorted by layer, dataset and object."""
        return self.layers.orderBy("layer", "dataset_id", "object_id")

    def depth(self) -> DataFrame:
        """One row: the number of layers, 0 for an empty graph."""
        return self.layers.agg(F.coalesce(F.max("layer"), F.lit(0)).cast("bigint").alias("depth"))


def node_key(dataset: Column, obj: Column) -> Column:
    return F.concat(dataset, F.lit("\0"), obj)


def _is_blank(value: Column) -> Column:
    return trim_edges(F.coalesce(value, F.lit(""))) == ""


def blank_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes whose dataset or object id is null or only white space."""
    return nodes.filter(_has_blank_id())


def _raise_blank(nodes: DataFrame) -> None:
    row = blank_nodes(nodes).first()
    if not (row["object_id"] or "").strip():
        raise BlankIdError(f"object_id is empty (dataset_id={row['dataset_id']!r})")
    raise BlankIdError(f"dataset_id is empty or could not be derived (object_id={row['object_id']!r})")


def _has_blank_id() -> Column:
    return _is_blank(F.col("object_id")) | _is_blank(F.col("dataset_id"))


def duplicate_nodes(nodes: DataFrame) -> DataFrame:
    """Objects listed more than once, with their number of entries."""
    by = [name for name in ("key", "dataset_id", "object_id") if name in nodes.columns]
    entries = nodes.groupBy(*by).agg(F.count(F.lit(1)).alias("entries"))
    return entries.filter(F.col("entries") > 1).select("dataset_id", "object_id", "entries")


def is_metadata(dataset: Column, obj: Column, object_type: Column) -> Column:
    """Tables and anything in the metadata schema: not created by scripts."""
    return (
        (F.upper(F.coalesce(object_type, F.lit(""))) == "TABLE")
        | F.contains(F.upper(obj), F.lit(METADATA_SCHEMA))
        | (F.upper(dataset) == METADATA_SCHEMA)
    )


def candidate_edges(edges: DataFrame) -> DataFrame:
    """``(src, dep)`` keys without metadata dependencies and self-edges; repeats stay."""
    kept = edges.filter(
        ~is_metadata(F.col("dep_dataset"), F.col("dep_object"), F.col("dep_type"))
    ).select(
        node_key(F.col("src_dataset"), F.col("src_object")).alias("src"),
        node_key(F.col("dep_dataset"), F.col("dep_object")).alias("dep"),
    )
    return kept.filter("src != dep")


@dataclass(frozen=True)
class Edges:
    """Different edges (src, dep): ``light`` in buckets by dependency, ``heavy`` those of the few
    dependencies in ``names``, as they lie."""

    light: DataFrame
    heavy: DataFrame
    names: DataFrame

    def all(self) -> DataFrame:
        return self.light.unionAll(self.heavy)

    def to(self, nodes: DataFrame, rows: int | None = None) -> DataFrame:
        """The edges whose dependency is among ``nodes`` (key, layer), with that layer.

        The nodes lie in buckets by key and number ``rows`` at most; unless they are few, only those in
        ``names`` are broadcast.
        """
        few = nodes.join(F.broadcast(self.names), nodes["key"] == self.names["dep"], "left_semi")
        return self.light.join(_probed(nodes, rows), F.col("dep") == F.col("key")).unionAll(
            self.heavy.join(F.broadcast(few), F.col("dep") == F.col("key"))
        )


def _keyed_nodes(nodes: DataFrame) -> DataFrame:
    """The nodes with their ``key``, in buckets by it. Raises on blank ids."""
    key = F.coalesce(node_key(F.col("dataset_id"), F.col("object_id")), F.lit(""))
    keyed = _dealt(nodes.select(key.alias("key"), "dataset_id", "object_id", "object_type"), "key")
    table, counts = bucketed_stage(keyed, "key", blank=F.count_if(_has_blank_id()))
    if counts["blank"]:
        _raise_blank(table)
    return table


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(bucket_count(df.sparkSession), key)


def _probed(nodes: DataFrame, rows: int | None, few: int = BROADCAST_MOST) -> DataFrame:
    """``nodes`` as a join's side that is looked up, so that the other one is not sorted; as they are
    where they may be too many (``rows`` at most) for the tasks to hold."""
    if rows is None or rows > HASHED_MOST * bucket_count(nodes.sparkSession):
        return nodes
    return F.broadcast(nodes) if rows <= few else nodes.hint("shuffle_hash")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _managed(keys: DataFrame, edges: DataFrame, heavy_most: int = HEAVY_MOST) -> Edges:
    """The candidate edges whose dependency is among ``keys`` (key)."""
    sketch = F.expr(f"approx_top_k(dep, {heavy_most}, {TRACKED})")
    candidates, counts = counted_stage(candidate_edges(edges), heavy=sketch)
    least = counts["rows"] / heavy_most
    names = [(item["item"],) for item in counts["heavy"] or [] if item["count"] > least]
    names = edges.sparkSession.createDataFrame(names, "dep string")
    known = keys.join(F.broadcast(names), F.col("key") == F.col("dep"), "left_semi")
    heavy = candidates.join(F.broadcast(known), F.col("dep") == F.col("key"), "left_semi").distinct()
    light = _dealt(candidates.join(F.broadcast(names), "dep", "left_anti").select("src", "dep"), "dep").distinct()
    light = light.join(keys, F.col("dep") == F.col("key"), "left_semi")
    return Edges(bucketed_stage(light, "dep")[0], stage_table(heavy), names)


def managed_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The candidate edges whose dependency is a node of the graph."""
    keys = nodes.select(node_key(F.col("dataset_id"), F.col("object_id")).alias("key")).distinct()
    return _managed(keys, edges).all().select("src", "dep")


def indegrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Number of managed dependencies of each node."""
    counts = managed_edges(nodes, edges).groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    key = node_key(F.col("dataset_id"), F.col("object_id"))
    return nodes.join(counts, key == F.col("src"), "left").select(
        "dataset_id",
        "object_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("indegree"),
    )


def compute_layers(nodes: DataFrame, edges: DataFrame, heavy_most: int = HEAVY_MOST) -> Layering:
    """Layers of ``nodes(dataset_id, object_id, object_type)`` under
    ``edges(src_dataset, src_object, dep_dataset, dep_object, dep_type)``, from layer 1 on.

    Raises on blank ids, on an object listed twice, and on a cycle.
    """
    nodes = _keyed_nodes(nodes)
    managed = _managed(nodes.select("key"), edges, heavy_most)
    state, waiting = _first_state(nodes, managed)
    total = state.count()
    fresh = total - waiting
    paths, on_paths, jobs = _paths(managed, state)
    ends = None
    if paths is not None:
        # the other nodes of a path are settled with its head
        state = bucketed_stage(state.join(paths, F.col("key") == F.col("node"), "left_anti"), "key")[0]
        waiting -= on_paths
        last = paths.groupBy("head").agg(F.max(F.struct("steps", "node")).alias("last"))
        ends = stage_table(last.select("head", F.col("last.node").alias("node"), F.col("last.steps").alias("steps")))

    settled = [state.filter("left = 0").select("key", "layer")]
    told = None
    while waiting:
        following = _round(state, managed, ends, told, fresh, waiting)
        told, counts = bucketed_stage(following, "key", fresh=F.count_if(F.col("left") == 0))
        jobs, fresh = jobs + 1, counts["fresh"]
        if not fresh:
            known = _union(settled).select(F.col("key").alias("known"))
            raise _cycle(state.join(known, F.col("key") == F.col("known"), "left_anti").select("key"), paths)
        settled.append(told.filter("left = 0").select("key", "layer"))
        waiting -= fresh
    return Layering(stage_table(_layered(nodes, settled, paths, total)), jobs)


def _first_state(nodes: DataFrame, edges: Edges) -> tuple[DataFrame, int]:
    """key, the number of dependencies ``left`` to settle and the ``layer`` so far, in buckets by key;
    the number of nodes that have to wait. Raises on an object listed twice."""
    left = edges.all().groupBy("src").agg(F.count(F.lit(1)).alias("left"))
    entries = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("entries"))
    first = entries.join(left, F.col("key") == F.col("src"), "left").select(
        "key", F.coalesce("left", F.lit(0)).alias("left"), F.lit(1).cast("bigint").alias("layer"), "entries"
    )
    state, counts = bucketed_stage(
        first, "key", waiting=F.count_if(F.col("left") > 0), repeated=F.count_if(F.col("entries") > 1)
    )
    if counts["repeated"]:
        row = duplicate_nodes(nodes).orderBy("dataset_id", "object_id").first()
        raise DuplicateObjectError(f"duplicate entry for {row['dataset_id']}.{row['object_id']}")
    return state.drop("entries"), counts["waiting"]


def _round(
    state: DataFrame,
    edges: Edges,
    ends: DataFrame | None,
    told: DataFrame | None = None,
    fresh: int | None = None,
    waiting: int | None = None,
) -> DataFrame:
    """The nodes of ``state`` that were told anything and wait, after all that were settled last have spoken.

    ``told`` is what the round before gave, none for the first: ``key``, the number of dependencies ``left``,
    the ``layer`` so far, and how many were ``heard`` of. ``fresh`` of them are settled, ``waiting`` nodes are not.
    """
    last = (state if told is None else told).filter("left = 0").select("key", "layer")
    if ends is not None:
        behind = last.join(ends, F.col("key") == F.col("head")).select(
            F.col("node").alias("key"), (F.col("layer") + F.col("steps")).alias("layer")
        )
        last = last.unionAll(_dealt(behind, "key"))
    # with each path's head its last node speaks
    spoken = edges.to(last, None if fresh is None else 2 * fresh).select(
        "src", F.lit(1).cast("bigint").alias("n"), (F.col("layer") + 1).alias("above")
    )
    if told is not None:
        spoken = spoken.unionAll(told.filter("left > 0").select("key", "heard", "layer"))
    messages = spoken.groupBy("src").agg(F.sum("n").alias("heard"), F.max("above").alias("above"))
    waits = state.filter("left > 0").select("key", "left")
    return waits.join(_probed(messages, waiting, few=0), F.col("key") == F.col("src")).select(
        "key", (F.col("left") - F.col("heard")).alias("left"), F.col("above").alias("layer"), "heard"
    )


# --- paths ------------------------------------------------------------------------------------


def _paths(edges: Edges, state: DataFrame) -> tuple[DataFrame | None, int, int]:
    """(node, head, steps) of the nodes that follow another one on a path, in buckets by node; their
    number; the number of jobs. None if there is no path.

    A path that closes upon itself has no head; its nodes stay out, and what remains is a cycle.
    """
    one_dependency = state.filter("left = 1").select("key")
    count_and_source = (F.count(F.lit(1)).alias("n"), F.min("src").alias("src"))
    one_dependent = (
        edges.light.groupBy("dep").agg(*count_and_source)
        .unionAll(edges.heavy.groupBy("dep").agg(*count_and_source))
        .filter("n = 1")
    )
    links = one_dependent.join(one_dependency, F.col("src") == F.col("key")).select(
        F.col("src").alias("node"), F.col("dep").alias("head"), F.lit(1).cast("bigint").alias("steps")
    )
    links, counts = bucketed_stage(_dealt(links, "node"), "node")
    total, jobs, reach = counts["rows"], 1, 1
    if not total:
        return None, 0, jobs
    while True:
        links, counts = bucketed_stage(_hops(links), "node", open=F.count_if("open"))
        jobs, reach = jobs + 1, reach * (HOPS_PER_JOB + 1)
        if not counts["open"]:
            return links.drop("open"), total, jobs
        if reach > total:
            # no path is longer than all links together: what is still open runs in a circle
            links, counts = bucketed_stage(links.filter("NOT open").drop("open"), "node")
            return links, counts["rows"], jobs + 1
        links = links.drop("open")


def _hops(links: DataFrame) -> DataFrame:
    """Pointers followed ``HOPS_PER_JOB`` times; ``open`` while the end was not seen."""
    moved = links
    further = links.select(F.col("node").alias("at"), F.col("head").alias("next"), F.col("steps").alias("more"))
    for _ in range(HOPS_PER_JOB):
        moved = moved.join(further, F.col("head") == F.col("at"), "left").select(
            "node", F.coalesce("next", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("at").isNotNull().alias("open"),
        )
    return _dealt(moved, "node")


# --- results ----------------------------------------------------------------------------------


def _layered(nodes: DataFrame, settled: list[DataFrame], paths: DataFrame | None, total: int) -> DataFrame:
    dataset, obj = F.col("dataset_id"), F.col("object_id")
    known = _union(settled)
    if paths is not None:
        following = paths.join(known, F.col("head") == F.col("key")).select(
            F.col("node").alias("key"), (F.col("layer") + F.col("steps")).alias("layer")
        )
        known = known.unionAll(following)
    return nodes.join(_probed(known, total, few=0), "key").select(
        "layer",
        "dataset_id",
        "object_id",
        "object_type",
        resource_type(F.col("object_type")).alias("resource_type"),
        reference_id(dataset, obj).alias("reference_id"),
    )


def _cycle(waiting: DataFrame, paths: DataFrame | None) -> CyclicDependencyError:
    if paths is not None:
        behind = paths.join(waiting, F.col("head") == F.col("key")).select(F.col("node").alias("key"))
        waiting = waiting.unionAll(behind)
    remaining = (
        waiting.select(F.replace("key", F.lit("\0"), F.lit(".")).alias("reference_id"))
        .distinct()
        .orderBy("reference_id")
    )
    return CyclicDependencyError(
        f"cyclic dependency among {remaining.count()} objects; `remaining` lists them all", remaining
    )
