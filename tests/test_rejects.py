"""Rows that a load leaves out, malformed CSV rows, and hubs joined in parts."""

from __future__ import annotations

import json
import os
from collections import Counter

import pytest

import modern
from weftgraph import LoadOptions, StoredGraph, Triplet, check_sources, load_graph
from weftgraph.operators.adjacency import arranged, range_starts
from weftgraph.operators.endpoints import HEAVY, heavy_keys, matched_edges, resolved_edges
from weftgraph.plans.check import malformed_rows
from weftgraph.scratch import Scratch


@pytest.fixture
def sources(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return modern.write_files(folder)


def quoted_spec(sources):
    """The mapping with quotes that count as such."""
    return modern.spec(sources, lambda text: text.replace("quoting: false", "quoting: true"))


def rejected(graph, name):
    return sorted((r["reason"], r["raw"]) for r in graph.rejected(name).collect())


def test_input_is_kept_rows_and_rejects(spark, sources, tmp_path):
    with open(sources / "person.csv", "a") as file:
        file.write('\n|nobody|1\n7|odd|old\n8|short\n9|long|1|2\n10|"open|3\n4|again|1\n11|fine|5')
    with open(sources / "knows.csv", "a") as file:
        file.write("\n1|99|0.1\n|2|0.2\n98||0.3\n1|2|much\n1|4|0.6\n1|2|0.5|x")
    out = str(tmp_path / "out")
    report = load_graph(spark, modern.schema(), quoted_spec(sources), out, LoadOptions(on_error="reject"))
    graph = StoredGraph(spark, out)
    people = [r["id"] for r in graph.vertices("person").orderBy("vid").collect()]
    assert people == [1, 2, 6, 11]
    assert rejected(graph, "person") == [
        ("lost_cell", '{"id":"7","name":"odd","age":"old"}'),
        ("malformed_row", '10|"open|3'),
        ("malformed_row", "8|short"),
        ("malformed_row", "9|long|1|2"),
        ("null_key", '{"id":null,"name":"nobody","age":"1"}'),
        ("repeated_key", '{"id":4,"name":"again","age":1}'),
        ("repeated_key", '{"id":4,"name":"josh","age":32}'),
    ]
    assert report.vertices[0].rejects == {"lost_cell": 1, "malformed_row": 3, "null_key": 1, "repeated_key": 2}
    # Edges to rejected vertices have no vertex.
    knows = Counter(reason for reason, _ in rejected(graph, modern.KNOWS))
    assert knows == {"lost_cell": 1, "malformed_row": 1, "null_source": 1, "null_destination": 1, "no_destination": 3}
    assert graph.edges(modern.KNOWS).count() == 1
    lines = (sources / "knows.csv").read_text().splitlines()[1:]
    assert len(lines) == graph.edges(modern.KNOWS).count() + sum(knows.values())


def test_dangling_edges_are_kept_apart_by_default(spark, sources, tmp_path):
    with open(sources / "knows.csv", "a") as file:
        file.write("\n1|99|0.1\n|2|0.1\n98||0.1")
    out = str(tmp_path / "out")
    report = load_graph(spark, modern.schema(), modern.spec(sources), out, LoadOptions(file_format="parquet"))
    graph = StoredGraph(spark, out)
    assert report.edges[0].dangling == 3
    found = [(reason, json.loads(raw)) for reason, raw in rejected(graph, modern.KNOWS)]
    assert [reason for reason, _ in found] == ["no_destination", "null_destination", "null_source"]
    assert [row["weight"] for _, row in found] == [0.1] * 3 and found[2][1]["src"] is None
    assert graph.rejected(modern.CREATED).collect() == [] and graph.rejected("person").collect() == []
    assert not os.path.exists(os.path.join(graph.root, "rejects/vertices"))
    with pytest.raises(ValueError):
        graph.rejected(Triplet("a", "b", "c"))


def test_malformed_rows(spark, sources):
    (sources / "person.csv").write_text('id|name|age|more\n1|a|2|x\n2|b\n3|c|4|x|y\n4|"d|5|x\n5|e|6|"x\n6|f|no|x')
    schema, spec = modern.schema(), quoted_spec(sources)
    found = {r["line"]: r["fault"] for r in malformed_rows(spark, schema, spec, "person").collect()}
    assert found == {"2|b": "short_or_long", "3|c|4|x|y": "short_or_long", '4|"d|5|x': "unclosed_quote"}
    counts = {(r["name"], r["check"]): r["rows"] for r in check_sources(spark, schema, spec, malformed=True).collect()}
    assert counts["person", "malformed_rows"] == 3 and counts["person", "lost_cells"] == 1
    assert counts[str(modern.KNOWS), "malformed_rows"] == 0
    assert ("person", "malformed_rows") not in {(r["name"], r["check"]) for r in check_sources(spark, schema, spec).collect()}


PLAIN_JOIN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_heavy_keys_are_found(spark):
    edges = spark.range(0, 30_000, 1, 7).selectExpr("if(id % 3 = 0, 5, id) AS src", "if(id % 100 = 0, 'hub', if(id % 7 = 0, null, concat('k', id))) AS dst")
    found = heavy_keys(edges, ["src", "dst"])
    assert 5 in found["src"] and "hub" in found["dst"] and None not in found["dst"]
    assert max(len(keys) for keys in found.values()) <= HEAVY
    assert heavy_keys(edges.limit(0), ["src"]) == {"src": []} and heavy_keys(edges, []) == {}


def test_hubs_are_joined_in_parts_without_the_skew_join(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in PLAIN_JOIN}
    for k, v in PLAIN_JOIN.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 5, id % 2500) AS src", "if(id % 3 = 1, 7, id % 2500) AS dst", "id")
        index = spark.range(2000).selectExpr("id AS k", "id AS vid")
        sizes = {}
        for name, heavy in (("plain", None), ("parts", heavy_keys(edges, ["src", "dst"]))):
            found = matched_edges(edges, "src", "dst", index, index, heavy)
            found.selectExpr("row.*", "src_vid", "dst_vid").write.parquet(str(tmp_path / name))
            written = spark.read.parquet(str(tmp_path / name))
            sizes[name] = sorted(r["count"] for r in written.groupBy("_metadata.file_path").count().collect())
            assert written.count() == 60_000
            assert written.where("NOT (src_vid <=> if(src < 2000, src, null)) OR NOT (dst_vid <=> if(dst < 2000, dst, null))").isEmpty()
        assert sizes["plain"][-1] > 20_000 and sizes["parts"][-1] < 12_000
        kept = resolved_edges(edges, "src", "dst", index, index, heavy_keys(edges, ["src", "dst"]))
        assert kept.count() == edges.where("src < 2000 AND dst < 2000").count()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_are_sorted_and_written_once_in_their_final_layout(spark, tmp_path):
    edges = spark.range(0, 3000, 1, 4).selectExpr("id % 90 AS src_vid", "id % 70 AS dst_vid", "id AS range", "id AS edge_row")
    ready = arranged(edges, "source", 20, 3000, 300)
    assert ready.columns[:3] == ["vertex_chunk", "range_", "place"]
    ready.createOrReplaceTempView("ready_edges")
    columns = ", ".join(c for c in ready.columns if c not in ("vertex_chunk", "range_"))
    types = {f.name: f.dataType.simpleString() for f in ready.schema}
    listed = ", ".join(f"{c} {types[c]}" for c in types)
    spark.sql(f"CREATE TABLE laid_out ({listed}) USING orc PARTITIONED BY (vertex_chunk, range_) LOCATION '{tmp_path}/laid_out'")
    try:
        plan = spark.sql(f"EXPLAIN INSERT INTO laid_out SELECT {columns}, vertex_chunk, range_ FROM ready_edges").first()[0]
        assert plan.count("Sort [") == 1 and plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange") == 1
    finally:
        spark.sql("DROP TABLE laid_out")
    written = Scratch(spark).keep(ready, "ready")
    starts = range_starts(written).orderBy("vertex_chunk", "range").collect()
    assert sum(r["rows"] for r in starts) == 3000 and all(r["whole"] for r in starts)
    for one, other in zip(starts, starts[1:]):
        follows = other["vertex_chunk"] == one["vertex_chunk"]
        assert other["first_pos"] == (one["first_pos"] + one["rows"] if follows else 0)
