"""Endpoint resolution, adjacency and offsets against plain Python on a skewed multigraph."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from weftgraph.operators.adjacency import adjacency, keep_edges, offsets
from weftgraph.operators.endpoints import dangling_edges, resolved_edges
from weftgraph.operators.index import BadKeysError, key_index, vertex_index
from weftgraph.scratch import Scratch

CHUNK, PIECE = 40, 64


@pytest.fixture(scope="module")
def graph(spark):
    """A hub holds a third of the edges; a third of those are copies; some ends are null or unknown."""
    rng = random.Random(11)
    people = rng.sample(range(10_000), 150)
    places = [f"p{n}" for n in rng.sample(range(1000), 70)]
    hub, spot = people[3], places[5]
    edges = []
    for i in range(2400):
        src = hub if i % 3 == 0 else rng.choice(people)
        dst = spot if i % 9 == 0 else rng.choice(places)
        note = "same" if i % 9 == 0 else rng.choice([None, "a", "b"])
        if i % 50 == 1:
            src = None
        if i % 60 == 2:
            dst = "unknown"
        edges.append((src, dst, note))
    scratch = Scratch(spark)
    sources = key_index(spark.createDataFrame([(p,) for p in people], "k bigint"), "k", scratch, 20)
    places_index = key_index(spark.createDataFrame([(p,) for p in places], "k string"), "k", scratch, 20)
    frame = spark.createDataFrame(edges, "src bigint, dst string, note string").repartition(4)
    kept = keep_edges(resolved_edges(frame, "src", "dst", sources, places_index), scratch)
    src_vid = {k: i for i, k in enumerate(sorted(people))}
    dst_vid = {k: i for i, k in enumerate(sorted(places))}
    whole = [(src_vid[s], dst_vid[d], n) for s, d, n in edges if s in src_vid and d in dst_vid]
    lost = [e for e in edges if e[0] not in src_vid or e[1] not in dst_vid]
    return frame, sources, places_index, kept, whole, lost


def test_resolved(graph):
    *_, kept, whole, _ = graph
    assert Counter(tuple(r)[:3] for r in kept.collect()) == Counter(whole)


def test_dangling(graph):
    frame, sources, places, _, _, lost = graph
    assert Counter(tuple(r) for r in dangling_edges(frame, "src", "dst", sources, places).collect()) == Counter(lost)


def expected_places(whole, by):
    near, far = (0, 1) if by == "source" else (1, 0)
    key = lambda e: (e[near], e[far], e[2] is not None, e[2] or "")
    place, rows = Counter(), []
    for edge in sorted(whole, key=key):
        chunk = edge[near] // CHUNK
        rows.append((chunk, place[chunk] // PIECE, place[chunk], *edge))
        place[chunk] += 1
    return rows


@pytest.mark.parametrize("by", ["source", "destination"])
@pytest.mark.parametrize("rows_per_range", [100, None])
def test_adjacency(graph, by, rows_per_range):
    *_, kept, whole, _ = graph
    placed = adjacency(kept, by, Scratch(kept.sparkSession), CHUNK, PIECE, rows_per_range=rows_per_range)
    got = sorted((tuple(r) for r in placed.collect()), key=lambda r: r[:3])
    assert got == expected_places(whole, by)


@pytest.mark.parametrize("by, vertices", [("source", 150), ("destination", 70)])
def test_offsets_bracket_the_adjacency(graph, by, vertices):
    *_, kept, whole, _ = graph
    near = 0 if by == "source" else 1
    degree = Counter(e[near] for e in whole)
    expected = []
    for first in range(0, vertices, CHUNK):
        at, last = 0, min(first + CHUNK, vertices)
        for vid in range(first, last):
            expected.append((first // CHUNK, vid, at))
            at += degree[vid]
        expected.append((first // CHUNK, last, at))
    got = sorted(tuple(r) for r in offsets(kept, by, vertices, CHUNK).collect())
    assert got == expected


def test_a_hub_is_arranged_by_many_tasks(graph):
    """No range holds much more than its share, although one vertex holds a third of the edges."""
    from pyspark.sql import functions as F

    *_, kept, whole, _ = graph
    placed = adjacency(kept, "source", Scratch(kept.sparkSession), CHUNK, PIECE, rows_per_range=200)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2.5 * 200


def test_hot_endpoints_are_split_by_the_skew_join(spark, tmp_path):
    """With both sides too large to broadcast, the hot key's partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 5, id % 2000) AS src", "id % 2000 AS dst", "id")
        index = spark.range(2000).selectExpr("id AS k", "id AS vid")
        found = resolved_edges(edges, "src", "dst", index, index)
        found.write.parquet(str(tmp_path / "found"))
        counted = found.groupBy().count()
        assert counted.collect()[0]["count"] == 60_000
        final = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in final
    assert spark.read.parquet(str(tmp_path / "found")).count() == 60_000


def test_small_sides_are_broadcast_without_a_hint(spark):
    edges = spark.range(0, 1000).selectExpr("id % 10 AS src", "id % 7 AS dst")
    index = spark.range(10).selectExpr("id AS k", "id AS vid")
    found = resolved_edges(edges, "src", "dst", index, index)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "hint" not in text.lower() and "strategy" not in text.lower()


def test_index_needs_unique_keys(spark):
    frame = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k bigint")
    with pytest.raises(BadKeysError, match="1 null rows, 1 keys"):
        vertex_index(frame, "k", Scratch(spark))
    rows = sorted(tuple(r) for r in key_index(frame, "k", Scratch(spark)).collect())
    assert rows == [(1, 0), (2, 1)]


def test_the_wide_rows_of_a_label_are_shuffled_once(spark):
    frame = spark.range(5000).selectExpr("id * 3 AS k", "repeat('x', 50) AS wide")
    indexed, total = vertex_index(frame, "k", Scratch(spark), rows_per_range=500)
    assert total == 5000
    text = indexed._jdf.queryExecution().executedPlan().toString()
    # They were written in ranges; what is left is to add where each range begins.
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text
    assert "BroadcastHashJoin" in text
