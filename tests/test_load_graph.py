from __future__ import annotations

import os
from dataclasses import replace

import pytest

import modern
from modern import CREATED, KNOWS
from weftgraph import LoadOptions, SpecError, StoredGraph, load_graph
from weftgraph.operators.index import BadKeysError
from weftgraph.plans.load import DanglingEdgesError, UnstableSourceError, verify_edges
from weftgraph.scratch import scratch_root
from weftgraph.sinks.publication import GraphExistsError, IncompleteGraphError, claim
from weftgraph.spec import (
    ColumnMapping,
    DataSource,
    EdgeMapping,
    EdgePair,
    EdgeType,
    GraphSchema,
    ImportSpec,
    Property,
    Triplet,
    VertexMapping,
    VertexType,
)


def rows(frame, *order):
    return [tuple(r) for r in frame.orderBy(*order).collect()]


@pytest.fixture
def sources(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return modern.write_files(folder)


@pytest.fixture(params=["orc", "parquet"])
def stored(request, spark, sources, tmp_path):
    out = str(tmp_path / "out")
    report = load_graph(spark, modern.schema(), modern.spec(sources), out, LoadOptions(file_format=request.param))
    return report, StoredGraph(spark, out)


def test_six_vertices(stored):
    report, graph = stored
    assert rows(graph.vertices("person").select("vid", "id", "name", "age"), "vid") == [
        (0, 1, "marko", 29),
        (1, 2, "vadas", 27),
        (2, 4, "josh", 32),
        (3, 6, "peter", 35),
    ]
    assert rows(graph.vertices("software").select("vid", "id", "lang"), "vid") == [(0, 3, "java"), (1, 5, "java")]
    ends = ["src_vid", "dst_vid", "weight"]
    by_pos = ("vertex_chunk", "pos")
    for direction in ("source", "destination"):
        assert rows(graph.edges(KNOWS, direction).select(*ends, "vertex_chunk", "pos"), *by_pos) == [
            (0, 1, 0.5, 0, 0),
            (0, 2, 1.0, 0, 1),
        ]
    assert [r[:3] for r in rows(graph.edges(CREATED).select(*ends, "vertex_chunk", "pos"), *by_pos)] == [
        (0, 0, 0.4),
        (1, 1, 1.0),
        (2, 0, 0.4),
        (3, 0, 0.2),
    ]
    mirrored = graph.edges(CREATED, "destination").select(*ends, "vertex_chunk", "pos")
    assert [r[:3] for r in rows(mirrored, *by_pos)] == [(0, 0, 0.4), (2, 0, 0.4), (3, 0, 0.2), (1, 1, 1.0)]
    starts = lambda t, d: [r[2] for r in rows(graph.offsets(t, d), "vertex_chunk", "vid")]
    assert starts(KNOWS, "source") == [0, 2, 2, 2, 2]
    assert starts(KNOWS, "destination") == [0, 0, 1, 2, 2]
    assert starts(CREATED, "source") == [0, 1, 2, 3, 4]
    assert starts(CREATED, "destination") == [0, 3, 4]
    assert rows(graph.counts(), "kind", "name") == [
        ("edge", "person-created->software", 4),
        ("edge", "person-knows->person", 2),
        ("vertex", "person", 4),
        ("vertex", "software", 2),
    ]
    assert [(e.rows, e.dangling) for e in report.edges] == [(2, 0), (4, 0)]


def test_small_chunks_and_ranges(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    options = LoadOptions(vertex_chunk_size=2, edge_chunk_size=1, rows_per_range=1)
    load_graph(spark, modern.schema(), modern.spec(sources), out, options)
    graph = StoredGraph(spark, out)
    assert rows(graph.vertices("person").select("vertex_chunk", "vid"), "vid") == [(0, 0), (0, 1), (1, 2), (1, 3)]
    assert rows(graph.offsets(CREATED), "vertex_chunk", "vid") == [
        (0, 0, 0),
        (0, 1, 1),
        (0, 2, 2),
        (1, 2, 0),
        (1, 3, 1),
        (1, 4, 2),
    ]
    places = graph.edges(CREATED).select("vertex_chunk", "edge_chunk", "pos", "src_vid")
    assert rows(places, "src_vid") == [(0, 0, 0, 0), (0, 1, 1, 1), (1, 0, 0, 2), (1, 1, 1, 3)]
    assert os.path.isdir(os.path.join(graph.root, "vertices/person/vertex_chunk=1"))
    # The small table of starts tells which ranges hold an edge chunk, so only their files are read.
    one = graph.edges(CREATED, "source", vertex_chunk=1, edge_chunk=0)
    assert [r["src_vid"] for r in one.collect()] == [2]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "range#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(ValueError, match="vertex chunk"):
        graph.edges(CREATED, edge_chunk=0)


def test_source_naming(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    renamed = lambda text: text.replace("{index: 1, name: name}", "{index: 1, name: full.name}")
    load_graph(
        spark, modern.schema(), modern.spec(sources, renamed), out, LoadOptions(column_naming="source")
    )
    person = StoredGraph(spark, out).vertices("person")
    assert person.columns == ["vertex_chunk", "vid", "id", "full.name", "age"]
    assert [r["full.name"] for r in person.orderBy("vid").collect()] == ["marko", "vadas", "josh", "peter"]


def test_init_refuses_and_overwrite_replaces(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out, LoadOptions(vertex_chunk_size=1))
    with pytest.raises(GraphExistsError):
        load_graph(spark, modern.schema(), modern.spec(sources), out)
    assert StoredGraph(spark, out).manifest["vertex_chunk_size"] == 1
    (sources / "person.csv").write_text("id|name|age\n1|marko|29\n2|vadas|27")
    overwrite = lambda text: text.replace("import_option: init", "import_option: overwrite")
    report = load_graph(spark, modern.schema(), modern.spec(sources, overwrite), out)
    graph = StoredGraph(spark, out)
    assert graph.vertices("person").count() == 2
    assert [(e.rows, e.dangling) for e in report.edges] == [(1, 1), (2, 2)]


def test_overwrite_leaves_nothing_of_the_old_graph(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    overwrite = modern.spec(sources, lambda text: text.replace("import_option: init", "import_option: overwrite"))
    load_graph(spark, modern.schema(), replace(overwrite, edges=overwrite.edges[:1]), out)
    graph = StoredGraph(spark, out)
    assert len(graph.manifest["edges"]) == 1
    assert sorted(os.listdir(out)) == ["manifests", os.path.basename(graph.root)]
    assert len(os.listdir(os.path.join(graph.root, "edges/person"))) == 1


def test_a_failed_overwrite_leaves_the_old_graph(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    with open(sources / "person.csv", "a") as file:
        file.write("\n4|again|1")
    overwrite = modern.spec(sources, lambda text: text.replace("import_option: init", "import_option: overwrite"))
    with pytest.raises(BadKeysError):
        load_graph(spark, modern.schema(), overwrite, out)
    assert StoredGraph(spark, out).vertices("person").count() == 4
    assert len(os.listdir(out)) == 2


@pytest.mark.parametrize("name", ["{}", "file:{}", "file://{}", "{}/x/..", "{}/", "file:{}/./y/../"])
def test_an_input_below_the_target_is_refused_by_any_name(spark, sources, tmp_path, name):
    inside = tmp_path / "graph" / "vertices"
    inside.mkdir(parents=True)
    for file in list(sources.iterdir()):
        (inside / file.name).write_text(file.read_text())
    overwrite = modern.spec(inside, lambda text: text.replace("import_option: init", "import_option: overwrite"))
    with pytest.raises(SpecError, match="lies in the folder"):
        load_graph(spark, modern.schema(), overwrite, name.format(tmp_path / "graph"))
    assert (inside / "person.csv").exists()


def test_a_table_below_the_target_is_refused(spark, tmp_path):
    path = tmp_path / "graph" / "old"
    spark.range(3).selectExpr("id AS k").write.parquet(str(path))
    spark.read.parquet(str(path)).createOrReplaceTempView("own_table")
    schema = GraphSchema("g", (VertexType("V", (Property("k", "DT_SIGNED_INT64"),), ("k",)),))
    spec = ImportSpec("g", DataSource("table"), (VertexMapping("V", ("own_table",)),), import_option="overwrite")
    with pytest.raises(SpecError, match="lies in the folder"):
        load_graph(spark, schema, spec, str(tmp_path / "graph"))


def test_damaged_edges_are_noticed(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    graph = StoredGraph(spark, out)
    columns = next(e["columns"] for e in graph.manifest["edges"] if e["edge"] == "created")
    verify_edges(spark, graph.root, CREATED, "source", "orc", 4, columns)
    folder = os.path.join(graph.root, "edges/person/created/software/by_source/vertex_chunk=0/range=0")
    stored = spark.read.orc(folder)
    kept = stored.where("place != 2").collect()
    spark.createDataFrame(kept, stored.schema).write.mode("overwrite").orc(folder)
    with pytest.raises(UnstableSourceError):
        verify_edges(spark, graph.root, CREATED, "source", "orc", 4, columns)


def test_a_load_does_not_need_the_skew_join(spark, sources, tmp_path):
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        report = load_graph(spark, modern.schema(), modern.spec(sources), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert [e.rows for e in report.edges] == [2, 4]


def test_malformed_rows_are_dropped_alike_in_all_passes(spark, sources, tmp_path):
    (sources / "person.csv").write_text("id|name|age\n1|marko|29\n2|vadas|old\n4|josh|32\n6|peter|35")
    dropping = lambda text: text.replace("header_row:", "mode: DROPMALFORMED, header_row:", 1)
    spec = modern.spec(sources, dropping)
    assert spec.source.options["mode"] == "DROPMALFORMED"
    report = load_graph(spark, modern.schema(), spec, str(tmp_path / "out"))
    assert StoredGraph(spark, str(tmp_path / "out")).vertices("person").count() == 3
    assert (report.edges[0].rows, report.edges[0].dangling) == (1, 1)


def test_endpoints_of_any_name(spark, tmp_path):
    spark.range(5).selectExpr("id AS k", "id AS _key").createOrReplaceTempView("named_v")
    spark.range(4).selectExpr("id AS src_vid", "id + 1 AS dst_vid", "id AS _key", "id AS key").createOrReplaceTempView(
        "named_e"
    )
    number = "DT_SIGNED_INT64"
    schema = GraphSchema(
        "g",
        (VertexType("V", (Property("k", number), Property("_key", number)), ("k",)),),
        (EdgeType("E", (EdgePair("V", "V"),), (Property("_key", number), Property("key", number))),),
    )
    triplet = Triplet("V", "E", "V")
    ends = (ColumnMapping("src_vid"),), (ColumnMapping("dst_vid"),)
    spec = ImportSpec(
        "g",
        DataSource("table"),
        (VertexMapping("V", ("named_v",)),),
        (EdgeMapping(triplet, ("named_e",), *ends),),
    )
    load_graph(spark, schema, spec, str(tmp_path / "out"), LoadOptions(column_naming="source"))
    edges = StoredGraph(spark, str(tmp_path / "out")).edges(triplet).select("src_vid", "dst_vid", "_key", "key")
    assert rows(edges, "src_vid") == [(i, i + 1, i, i) for i in range(4)]


def test_unfinished_graph_is_refused(spark, sources, tmp_path):
    with pytest.raises(IncompleteGraphError):
        StoredGraph(spark, str(tmp_path / "nothing"))
    claim(spark, str(tmp_path / "half"), first=True)
    with pytest.raises(IncompleteGraphError):
        StoredGraph(spark, str(tmp_path / "half"))


@pytest.mark.parametrize("extra", ["4|again|1", "|nobody|1", "oops|nobody|1"])
def test_bad_keys_stop_the_load(spark, sources, tmp_path, extra):
    with open(sources / "person.csv", "a") as file:
        file.write("\n" + extra)
    out = str(tmp_path / "out")
    with pytest.raises(BadKeysError):
        load_graph(spark, modern.schema(), modern.spec(sources), out)
    with pytest.raises(IncompleteGraphError):
        StoredGraph(spark, out)


def test_dangling_policy(spark, sources, tmp_path):
    with open(sources / "knows.csv", "a") as file:
        file.write("\n1|99|0.1\n|2|0.1\n98||0.1")
    report = load_graph(spark, modern.schema(), modern.spec(sources), str(tmp_path / "drop"))
    assert [(e.rows, e.dangling) for e in report.edges] == [(2, 3), (4, 0)]
    with pytest.raises(DanglingEdgesError):
        load_graph(
            spark, modern.schema(), modern.spec(sources), str(tmp_path / "error"), LoadOptions(dangling="error")
        )


def test_out_only_edges_have_one_direction(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    from weftgraph import GraphSchema

    text = modern.SCHEMA_YAML.replace(
        "destination_vertex: software, relation: MANY_TO_MANY",
        "destination_vertex: software, x_csr_params: {edge_storage_strategy: ONLY_OUT}",
    )
    load_graph(spark, GraphSchema.from_yaml(text), modern.spec(sources), out)
    graph = StoredGraph(spark, out)
    assert graph.edges(KNOWS, "destination").count() == 2
    with pytest.raises(ValueError):
        graph.edges(CREATED, "destination")


def test_a_graph_is_not_written_over_its_inputs(spark, sources):
    for out in (sources, sources / "person.csv", sources / "person.csv" / "graph"):
        with pytest.raises(SpecError):
            load_graph(spark, modern.schema(), modern.spec(sources), str(out))
    assert sorted(os.listdir(sources)) == sorted(modern.FILES)


def test_empty_inputs(spark, sources, tmp_path):
    (sources / "person.csv").write_text("id|name|age")
    out = str(tmp_path / "out")
    report = load_graph(spark, modern.schema(), modern.spec(sources), out)
    assert [v.rows for v in report.vertices] == [0, 2]
    graph = StoredGraph(spark, out)
    assert graph.vertices("person").count() == 0
    assert graph.edges(CREATED).count() == 0
    assert [r["offset"] for r in graph.offsets(CREATED, "destination").orderBy("vid").collect()] == [0, 0, 0]


def test_scratch_is_discarded(spark, sources, tmp_path):
    shared = scratch_root(spark)
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    load_graph(spark, modern.schema(), modern.spec(sources), str(tmp_path / "out"))
    assert set(os.listdir(shared)) == before
