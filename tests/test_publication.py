"""Versions of a graph: crashes between any two steps, loads at the same time, inputs that must survive."""

from __future__ import annotations

import os
import threading

import pytest

import modern
from weftgraph import LoadOptions, SpecError, StoredGraph, load_graph
from weftgraph.plans import load, own_inputs
from weftgraph.sinks import publication
from weftgraph.sinks.publication import Entry, GraphExistsError, IncompleteGraphError


class Crash(BaseException):
    """The end of a driver: nothing runs after it."""


@pytest.fixture
def sources(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return modern.write_files(folder)


def overwriting(sources):
    return modern.spec(sources, lambda text: text.replace("import_option: init", "import_option: overwrite"))


def only(sources, count):
    """The first ``count`` persons stay in the source."""
    lines = (sources / "person.csv").read_text().splitlines()
    (sources / "person.csv").write_text("\n".join(lines[: 1 + count]))


def names(folder):
    return sorted(n for n in os.listdir(folder) if not n.startswith("."))


# Each is a step of a load in its order: what is called, and whether the new graph is there after a crash in it.
STEPS = [
    ("weftgraph.plans.load._store_vertices", False),
    ("weftgraph.plans.load._store_edges", False),
    ("weftgraph.sinks.publication.publish", False),
    ("weftgraph.sinks.publication.drop_replaced", True),
    ("weftgraph.sinks.publication._drop", True),
    ("weftgraph.sinks.publication.withdraw", True),
]


@pytest.mark.parametrize("step, published", STEPS)
def test_a_crash_between_steps_leaves_one_whole_graph(spark, sources, tmp_path, monkeypatch, step, published):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    only(sources, 2)

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(step, crash)
        # A dead driver does not tidy up.
        patch.setattr(load, "delete_folder", lambda *_: None)
        if not published:
            patch.setattr(publication, "withdraw", lambda *_: None)
        with pytest.raises(Crash):
            load_graph(spark, modern.schema(), overwriting(sources), out)
    graph = StoredGraph(spark, out)
    assert graph.vertices("person").count() == (2 if published else 4)
    assert graph.edges(modern.KNOWS).count() == (1 if published else 2)
    # The next load is not in the way of what is left, and what it left can be swept away.
    only(sources, 1)
    load_graph(spark, modern.schema(), overwriting(sources), out)
    graph = StoredGraph(spark, out)
    assert graph.vertices("person").count() == 1
    assert publication.sweep(spark, out) == (0 if published else 1)
    assert names(out) == ["manifests", os.path.basename(graph.root)]
    assert [e.state for e in publication.entries(spark, out)].count("complete") == 1
    assert graph.vertices("person").count() == 1


def test_a_crashed_first_load_is_not_readable_and_can_be_replaced(spark, sources, tmp_path, monkeypatch):
    out = str(tmp_path / "out")

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(publication, "publish", crash)
        patch.setattr(load, "delete_folder", lambda *_: None)
        patch.setattr(publication, "withdraw", lambda *_: None)
        with pytest.raises(Crash):
            load_graph(spark, modern.schema(), modern.spec(sources), out)
    with pytest.raises(IncompleteGraphError):
        StoredGraph(spark, out)
    with pytest.raises(GraphExistsError):
        load_graph(spark, modern.schema(), modern.spec(sources), out)
    assert publication.sweep(spark, out) == 1
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    assert StoredGraph(spark, out).vertices("person").count() == 4


def test_half_a_manifest_is_none(spark, tmp_path):
    out = str(tmp_path / "g")
    own = publication.claim(spark, out, first=True)
    spark.range(1).selectExpr("'{\"name\": \"gr' AS value").write.text(f"{own.folder(out)}/state=complete")
    with pytest.raises(IncompleteGraphError):
        publication.current(spark, out)


def test_two_loads_at_once(spark, sources, tmp_path):
    out = str(tmp_path / "out")
    load_graph(spark, modern.schema(), modern.spec(sources), out)
    begin, failures = threading.Barrier(2), []

    def run(size):
        try:
            begin.wait()
            load_graph(spark, modern.schema(), overwriting(sources), out, LoadOptions(vertex_chunk_size=size))
        except Exception as failure:  # noqa: BLE001
            failures.append(failure)

    threads = [threading.Thread(target=run, args=(size,)) for size in (1, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failures
    graph = StoredGraph(spark, out)
    assert graph.manifest["vertex_chunk_size"] in (1, 2)
    assert graph.vertices("person").count() == 4 and graph.edges(modern.CREATED).count() == 4
    assert names(out) == ["manifests", os.path.basename(graph.root)]


def test_a_load_that_ends_after_a_later_one_does_not_replace_it(spark, tmp_path):
    out = str(tmp_path / "g")
    early = publication.claim(spark, out, first=False)
    late = publication.claim(spark, out, first=False)
    assert (early.number, late.number) == (1, 2)
    publication.publish(spark, out, late, {"name": "late"})
    publication.drop_replaced(spark, out)
    # The early load may still be running: its claim stays.
    assert {e.load for e in publication.entries(spark, out)} == {early.load, late.load}
    publication.publish(spark, out, early, {"name": "early"})
    publication.drop_replaced(spark, out)
    assert publication.current(spark, out).manifest == {"name": "late"}
    assert {e.load for e in publication.entries(spark, out)} == {late.load}


def test_claims_that_meet_on_a_number_give_way(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "g")
    real, rival = publication._write, Entry(1, "rival", "claimed", {})

    def with_rival(spark, root, entry):
        # The rival claims after this load has looked, before its claim is there.
        monkeypatch.setattr(publication, "_write", real)
        real(spark, root, rival)
        real(spark, root, entry)

    monkeypatch.setattr(publication, "_write", with_rival)
    own = publication.claim(spark, out, first=False)
    assert own.number == 2
    assert sorted((e.number, e.load) for e in publication.entries(spark, out)) == [(1, "rival"), (2, own.load)]


def test_two_first_loads_are_not_both_accepted(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "g")
    real = publication._write

    def with_rival(spark, root, entry):
        monkeypatch.setattr(publication, "_write", real)
        real(spark, root, Entry(1, "rival", "claimed", {}))
        real(spark, root, entry)

    monkeypatch.setattr(publication, "_write", with_rival)
    with pytest.raises(GraphExistsError):
        publication.claim(spark, out, first=True)
    assert [e.load for e in publication.entries(spark, out)] == ["rival"]


def copied_into(graph, sources, below):
    inside = os.path.join(graph.root, below)
    os.makedirs(inside)
    for name in os.listdir(sources):
        with open(os.path.join(inside, name), "w") as file:
            file.write((sources / name).read_text())
    return inside


@pytest.mark.parametrize("by_alias", ["input", "target", "neither, but a mount"])
def test_inputs_in_the_old_version_survive(spark, sources, tmp_path, monkeypatch, by_alias):
    real = tmp_path / "real"
    real.mkdir()
    alias = tmp_path / "alias"
    alias.symlink_to(real)
    out = {"input": real, "target": alias}.get(by_alias, alias) / "g"
    load_graph(spark, modern.schema(), modern.spec(sources), str(real / "g"))
    graph = StoredGraph(spark, str(real / "g"))
    inside = copied_into(graph, sources, "inputs")
    if by_alias == "input":
        inside = inside.replace(str(real), str(alias))
    if by_alias.startswith("neither"):
        monkeypatch.setattr(os.path, "realpath", os.path.abspath)
    from pathlib import Path

    with pytest.raises(SpecError, match="lies in the folder"):
        load_graph(spark, modern.schema(), overwriting(Path(inside)), str(out))
    assert StoredGraph(spark, str(real / "g")).vertices("person").count() == 4
    assert os.path.exists(os.path.join(inside, "person.csv"))


@pytest.mark.parametrize(
    "one, other, same",
    [
        ("hdfs://nn/g/in", "hdfs://nn:8020/g", True),
        ("hdfs://NN:9000/g/in", "hdfs://nn:8020/g/", True),
        ("hdfs://nn/g/in", "hdfs://other/g", False),
        ("/g/in", "hdfs://other/g", True),
        ("hdfs://nn/g2", "hdfs://nn/g", False),
        ("s3a://bucket/a/../g/x", "s3a://bucket/g", True),
    ],
)
def test_overlap_by_name(one, other, same):
    assert own_inputs.overlap(one, other) is own_inputs.overlap(other, one) is same


def test_roots_of_tables_are_not_listed_file_by_file(spark, tmp_path):
    spark.range(30).selectExpr("id", "id % 3 AS p").createOrReplaceTempView("some_rows")
    spark.sql(f"CREATE TABLE plain_table USING parquet LOCATION '{tmp_path}/plain' AS SELECT id FROM some_rows")
    spark.sql(f"CREATE TABLE cut_table USING parquet PARTITIONED BY (p) LOCATION '{tmp_path}/cut' AS SELECT * FROM some_rows")
    try:
        spec = type("S", (), {"source": type("D", (), {"kind": "table", "location": ""})})
        assert list(own_inputs.input_roots(spark, spec, "plain_table")) == [f"file:{tmp_path}/plain"]
        cut = sorted(own_inputs.input_roots(spark, spec, "cut_table"))
        assert [os.path.basename(c) for c in cut] == ["p=0", "p=1", "p=2"]
    finally:
        spark.sql("DROP TABLE plain_table")
        spark.sql("DROP TABLE cut_table")
