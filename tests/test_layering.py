"""Layers, and the graphs that have none."""

import random

import pytest
from pyspark.sql import functions as F

from scriptloom.operators import layering, outputs
from scriptloom.plans.lineage import creation_order, lineage
from scriptloom.sources.scripts import graph_of, load_scripts

OBJECTS = (
    "dataset_id string, object_id string, object_type string, references"
    " array<struct<dataset_id:string,object_id:string,object_type:string,resource_type:string>>"
)


def graph(spark, *objects):
    rows = [
        (d, o, t, [(rd, ro, rt, None) for rd, ro, rt in refs]) for d, o, t, refs in objects
    ]
    return graph_of(spark.createDataFrame(rows, OBJECTS))


def layered(spark, *objects, **options):
    result = layering.compute_layers(*graph(spark, *objects), **options)
    return [tuple(r) for r in result.ordered().collect()]


def test_chain(spark):
    fn = "SCALAR_FUNCTION"
    assert layered(spark, ("d", "b", fn, [("d", "a", fn)]), ("d", "a", fn, [])) == [
        (1, "d", "a", fn, "ROUTINE", "d.a"), (2, "d", "b", fn, "ROUTINE", "d.b")]


def test_dropped_dependencies(spark):
    got = layered(spark, (
        "d", "v1", "VIEW",
        [("d", "ext", "VIEW"), ("d", "INFORMATION_SCHEMA.TABLES", "TABLE"), ("d", "v1", "VIEW"),
         ("d", "v2", "table"), ("D", "v2", "VIEW"), ("information_schema", "v2", "VIEW")],
    ), ("d", "v2", "VIEW", []))
    assert [(r[0], r[2], r[4]) for r in got] == [(1, "v1", "VIEW"), (1, "v2", "VIEW")]


def test_longest_path_and_repeats(spark):
    f = "SCALAR_FUNCTION"
    got = layered(spark, ("d", "a", f, []), ("d", "b", f, [("d", "a", f)] * 3),
                  ("d", "c", f, [("d", "a", f), ("d", "b", f)]), ("c", "z", "MATERIALIZED_VIEW", []))
    assert [(r[0], r[5], r[4]) for r in got] == [
        (1, "c.z", "VIEW"), (1, "d.a", "ROUTINE"), (2, "d.b", "ROUTINE"), (3, "d.c", "ROUTINE")]


def test_hub(spark):
    """Everything points at one object."""
    f = "VIEW"
    objects = [("d", "hub", f, [("d", "root", f)]), ("d", "root", f, [])]
    objects += [("d", f"n{i}", f, [("d", "hub", f), ("d", "root", f)]) for i in range(300)]
    got = layered(spark, *objects)
    assert [r[0] for r in got] == [1, 2] + [3] * 300


def test_depth_beyond_one_job(spark):
    """A chain of eleven, one round a job and several."""
    objects = [("d", f"n{i}", "VIEW", [("d", f"n{i - 1}", "VIEW"), ("d", "n0", "VIEW")])
               for i in range(11)]
    got = layered(spark, *objects)
    assert [(r[0], r[2]) for r in got] == [(i + 1, f"n{i}") for i in range(11)]


def test_hot_dependency_and_its_plan(spark):
    """A third of all edges on one object: kept apart by the sketch, never dealt by dependency."""
    f = "VIEW"
    objects = [("d", "hub", f, [("d", "n0", f)]), ("d", "n0", f, [])]
    objects += [("d", f"n{i}", f, [("d", "hub", f), ("d", f"n{i // 2}", f), ("d", f"n{i // 3}", f)]) for i in range(1, 3000)]
    nodes, edges = graph(spark, *objects)
    keyed = layering._keyed_nodes(nodes)
    managed = layering._managed(keyed.select("key"), edges, heavy_most=50)
    assert [r["dep"] for r in managed.names.collect()] == ["d\0hub"]
    assert managed.heavy.count() == 2999 and managed.light.filter("dep = 'd\0hub'").count() == 0
    state, _ = layering._first_state(keyed, managed)
    plan = layering._round(state, managed, None)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert exchanged and all("hashpartitioning(src" in line for line in exchanged)  # messages only
    depth = {"n0": 1, "hub": 2}
    for i in range(1, 3000):
        depth[f"n{i}"] = 1 + max(2, depth[f"n{i // 2}"] if i > 1 else 1, depth[f"n{i // 3}"])
    for heavy in (1, 50):
        got = layering.compute_layers(nodes, edges, heavy_most=heavy).layers.collect()
        assert {r["object_id"]: r["layer"] for r in got} == depth


def test_a_round_holds_only_what_was_told(spark):
    """Nodes that no settled node spoke to are read, not written again; what was heard is carried on."""
    f = "VIEW"
    objects = [("d", f"n{i}", f, [("d", f"n{i // 2}", f), ("d", f"n{i // 3}", f)] if i else []) for i in range(400)]
    keyed = layering._keyed_nodes(graph(spark, *objects)[0])
    managed = layering._managed(keyed.select("key"), graph(spark, *objects)[1])
    state, waiting = layering._first_state(keyed, managed)
    assert waiting == 399
    first = layering._round(state, managed, None, None, 1, waiting)
    assert sorted((r["key"], r["left"], r["layer"]) for r in first.collect()) == [
        ("d\0n1", 0, 2), ("d\0n2", 1, 2)]
    second = layering._round(state, managed, None, first, 1, waiting - 1)
    assert sorted((r["key"], r["left"], r["layer"]) for r in second.collect()) == [
        ("d\0n2", 0, 3), ("d\0n3", 0, 3), ("d\0n4", 1, 3), ("d\0n5", 1, 3)]


def brute_layers(objects):
    known = {(d, o) for d, o, _, _ in objects}
    needs = {(d, o): {r[:2] for r in refs if r[:2] in known and r[:2] != (d, o)} for d, o, _, refs in objects}
    layer, turn = {}, 0
    while ready := [k for k in needs if k not in layer and needs[k] <= layer.keys()]:
        turn += 1
        layer.update(dict.fromkeys(ready, turn))
    return layer, sorted(".".join(k) for k in needs.keys() - layer.keys())


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    """Chains, hubs, repeats and (in half of the graphs) cycles, against peeling in plain Python."""
    rnd, f = random.Random(seed), "VIEW"
    n = 120
    refs = {i: [] for i in range(n)}
    for i in range(1, n):
        if rnd.random() < 0.6:
            refs[i].append(i - 1)  # stretches of chains
        refs[i] += rnd.choices(range(i), k=rnd.choice((0, 0, 0, 1, 3)))
    if seed % 2:
        for i in rnd.sample(range(n - 20), 2):
            refs[i].append(i + rnd.randint(1, 15))
    if seed == 3:
        refs |= {n: [n + 2], n + 1: [n], n + 2: [n + 1]}  # links that run in a circle
    objects = [(f"d{i % 3}", f"n{i}", f, [(f"d{r % 3}", f"n{r}", f) for r in found]) for i, found in refs.items()]
    layer, left = brute_layers(objects)
    nodes, edges = graph(spark, *objects)
    if left:
        with pytest.raises(layering.CyclicDependencyError) as error:
            layering.compute_layers(nodes, edges)
        assert [r[0] for r in error.value.remaining.collect()] == left
    else:
        got = layering.compute_layers(nodes, edges).layers.collect()
        assert {(r["dataset_id"], r["object_id"]): r["layer"] for r in got} == layer


def test_long_chain_takes_few_jobs(spark):
    """A chain of 700 with a tail of branches: the logarithm of its length, not its length."""
    f = "VIEW"
    objects = [("d", f"n{i}", f, [("d", f"n{i - 1}", f)] if i else []) for i in range(700)]
    objects += [("d", f"b{i}", f, [("d", "n699", f), ("d", "n3", f)]) for i in range(3)]
    result = layering.compute_layers(*graph(spark, *objects))
    want = {f"n{i}": i + 1 for i in range(700)} | {f"b{i}": 701 for i in range(3)}
    assert {r["object_id"]: r["layer"] for r in result.layers.collect()} == want
    assert result.jobs <= 10


def test_cycle(spark):
    f = "SCALAR_FUNCTION"
    nodes, edges = graph(
        spark, ("d", "a", f, [("d", "b", f)]), ("d", "b", f, [("d", "a", f)]),
        ("d", "after", f, [("d", "a", f)]), ("d", "free", f, []))
    with pytest.raises(layering.CyclicDependencyError, match="cyclic.*among 3 objects") as error:
        layering.compute_layers(nodes, edges)
    assert [r[0] for r in error.value.remaining.collect()] == ["d.a", "d.after", "d.b"]


def test_bad_nodes(spark):
    with pytest.raises(layering.DuplicateObjectError, match="duplicate.*d.a"):
        layered(spark, ("d", "a", "VIEW", []), ("d", "a", "VIEW", []))
    with pytest.raises(layering.BlankIdError, match="dataset_id"):
        layered(spark, (None, "a", "VIEW", []))
    with pytest.raises(layering.BlankIdError, match="object_id"):
        layered(spark, ("d", " ", "VIEW", []))


def test_empty(spark):
    nodes, edges = graph(spark)
    result = layering.compute_layers(nodes, edges)
    assert result.layers.count() == 0 and result.depth().collect()[0][0] == 0


def test_indegrees(spark):
    nodes, edges = graph(spark, ("d", "a", "VIEW", []),
                         ("d", "b", "VIEW", [("d", "a", "VIEW"), ("d", "x", "VIEW")]))
    got = {r["object_id"]: r["indegree"] for r in layering.indegrees(nodes, edges).collect()}
    assert got == {"a": 0, "b": 1}


FILES = {
    "ds1.f1.sql": "CREATE FUNCTION ds1.f1() RETURNS INT64\nAS (\n  (SELECT COUNT(*) FROM"
    " ds1.INFORMATION_SCHEMA.TABLES)\n);\n",
    "ds1.f2.sql": "CREATE FUNCTION ds1.f2() RETURNS INT64 AS (ds1.f1() + 1);",
    "ds1.f3.sql": "CREATE FUNCTION ds1.f3() RETURNS INT64 AS (ds1.f2() + 1);",
    "ds1.v1.sql": "CREATE VIEW ds1.v1 AS\nSELECT ds2.g(x) FROM ds1.INFORMATION_SCHEMA.TABLES",
    "ds1.v2.sql": "CREATE VIEW ds1.v2 AS\nSELECT x FROM ds1.v1",
    "ds1.v3.sql": "CREATE VIEW ds1.v3 AS\nSELECT x FROM ds1.v2;",
}


@pytest.fixture
def script_folder(tmp_path):
    for name, sql in FILES.items():
        (tmp_path / name).write_text(sql)
    return str(tmp_path)


def test_files_to_stages(spark, script_folder, tmp_path_factory):
    scripts = load_scripts(spark, script_folder)
    assert {r["script_id"] for r in scripts.collect()} == {n[:-4] for n in FILES}
    result = lineage(scripts, "proj")
    staged = outputs.stages(result.layering.layers, result.objects)
    assert {(r["reference_id"], r["layer"]) for r in staged.collect()} == {
        (f"ds1.{kind}{i}", i) for kind in "fv" for i in (1, 2, 3)}
    path = str(tmp_path_factory.mktemp("out") / "stages")
    outputs.write_stages(staged, path)
    second = spark.read.parquet(path).filter(F.col("layer") == 2)
    assert {r["object_id"] for r in second.collect()} == {"f2", "v2"}
    assert [tuple(r) for r in outputs.grants(result.objects).collect()] == [
        ("ds2", None, "ds1", "v1", "VIEW")]
    assert creation_order(scripts).depth().collect()[0][0] == 3


@pytest.mark.parametrize("blank", ["\t", " \n", "\u3000", None])
def test_white_space_ids_are_blank(spark, blank):
    nodes = spark.createDataFrame([("d", blank, "VIEW")], "dataset_id string, object_id string, object_type string")
    edges = spark.createDataFrame([], "src_dataset string, src_object string, dep_dataset string, dep_object string, dep_type string")
    with pytest.raises(layering.BlankIdError):
        layering.compute_layers(nodes, edges)


def test_lineage_returns_what_it_rejects(spark, make_scripts):
    scripts = make_scripts(
        {"bad": "CREATE FUNCTION d.f(x INT64", "view": "CREATE VIEW d.v AS SELECT d.f(1) AS y"}
    )
    result = lineage(scripts)
    assert [r["script_id"] for r in result.rejects.collect()] == ["bad"]
    assert [r["object_id"] for r in result.layering.ordered().collect()] == ["v"]


def test_files_of_one_name_stay_apart(spark, tmp_path):
    for folder in ("a b", "c"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.sql").write_text(f"CREATE VIEW d.{folder[0]} AS SELECT 1")
    below = load_scripts(spark, f"{tmp_path}/*/*.sql").collect()
    assert len({r["script_id"] for r in below}) == 2
    assert all(r["script_id"].endswith("/x") for r in below)
    alone = load_scripts(spark, f"{tmp_path}/c/x.sql").collect()
    assert [r["script_id"] for r in alone] == ["x"]
    assert [r["script_id"] for r in load_scripts(spark, f"file://{tmp_path}/c").collect()] == ["x"]


def staged_rows(spark, layers):
    rows = [(layer, f"d.{name}", name) for layer, name in layers]
    return spark.createDataFrame(rows, "layer long, reference_id string, script_id string")


def read_back(spark, path):
    return sorted((r["layer"], r["script_id"]) for r in spark.read.parquet(path).collect())


def test_stages_are_replaced_layer_by_layer(spark, tmp_path):
    path = str(tmp_path / "stages")
    outputs.write_stages(staged_rows(spark, [(1, "a"), (2, "b"), (2, "c"), (3, "z")]), path)
    outputs.write_stages(staged_rows(spark, [(2, "d")]), path, partial=True)
    assert read_back(spark, path) == [(1, "a"), (2, "d"), (3, "z")]
    fails = staged_rows(spark, [(1, "x"), (2, "y")]).withColumn(
        "script_id", F.when(F.col("layer") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("script_id"))
    )
    with pytest.raises(Exception, match="no"):
        outputs.write_stages(fails, path)
    assert read_back(spark, path) == [(1, "a"), (2, "d"), (3, "z")]
    outputs.write_stages(staged_rows(spark, [(1, "a"), (2, "b")]), path)
    assert read_back(spark, path) == [(1, "a"), (2, "b")]


def test_repeated_script_ids_and_rejects_come_with_the_order(spark):
    rows = [("a", "CREATE VIEW d.a AS SELECT 1"), ("b", "CREATE VIEW d.b AS SELECT x FROM d.a"), ("b", "DROP"), ("b", "")]
    result = creation_order(spark.createDataFrame(rows, "script_id string, sql string"))
    assert [tuple(r) for r in result.repeated.collect()] == [("b", 3)]
    assert sorted(r["script_id"] for r in result.rejects.collect()) == ["b", "b"]
    assert [r["object_id"] for r in result.ordered().collect()] == ["a", "b"]
