"""Times the stages of a graph load; prints one JSON line.

Each stage runs twice and the better time counts, so that compiling the plan's
code is not measured; ``load_graph`` is the whole load, from tables to manifest.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local threads (default 8)
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import DataFrame, SparkSession

from weftgraph import LoadOptions, StoredGraph, load_graph
from weftgraph.operators.adjacency import adjacency, keep_edges, offsets
from weftgraph.operators.endpoints import dangling_edges, resolved_edges
from weftgraph.operators.index import key_index, vertex_index
from weftgraph.operators.mapping import edge_frame, vertex_frame
from weftgraph.plans.table_graph import register_tables, table_schema, table_spec
from weftgraph.plans.table_queries import BUILDING_PLACED, CONTAINS, PLACED
from weftgraph.scratch import Scratch

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
VERTEX_CHUNK, EDGE_CHUNK = 1 << 14, 1 << 16


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("weftgraph-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    register_tables(spark, FOLDER)
    schema, scratch = table_schema(), Scratch(spark)
    labels, triplets = ["Customer", "Order", "Part"], [PLACED, CONTAINS]
    spec = table_spec(labels, triplets)
    dangling_spec = table_spec(["BuildingCustomer", "Order"], [BUILDING_PLACED])

    def vertices(label: str) -> DataFrame:
        return vertex_frame(spark, schema, spec, label).frame

    lines = edge_frame(spark, schema, spec, CONTAINS).frame
    timings: dict[str, float] = {}

    def timed(name: str, work):
        for _ in range(2):
            started = time.perf_counter()
            result = work()
            spent = round(time.perf_counter() - started, 3)
            timings[name] = min(spent, timings.get(name, spent))
        return result

    timed("vertex_projection", lambda: run(vertices("Order")))
    timed("edge_projection", lambda: run(lines))
    timed("vertex_index", lambda: run(vertex_index(vertices("Order"), "id", scratch)[0]))
    orders = scratch.keep(key_index(vertices("Order"), "id", scratch), "index")
    parts = scratch.keep(key_index(vertices("Part"), "id", scratch), "index")
    timed("edge_resolved", lambda: run(resolved_edges(lines, "src", "dst", orders, parts)))
    building = vertex_frame(spark, schema, dangling_spec, "BuildingCustomer").frame
    sparse = scratch.keep(key_index(building, "id", scratch), "index")
    placed = edge_frame(spark, schema, dangling_spec, BUILDING_PLACED).frame
    timed("dangling_edges", lambda: run(dangling_edges(placed, "src", "dst", sparse, orders)))
    kept = timed(
        "keep_edges", lambda: keep_edges(resolved_edges(lines, "src", "dst", orders, parts), scratch)
    )
    for by, index in (("source", orders), ("destination", parts)):
        timed(f"adjacency_by_{by}", lambda: run(adjacency(kept, by, scratch, VERTEX_CHUNK, EDGE_CHUNK)))
        vertices_of = index.count()
        timed(f"offsets_by_{by}", lambda: run(offsets(kept, by, vertices_of, VERTEX_CHUNK)))
    options = LoadOptions(vertex_chunk_size=VERTEX_CHUNK, edge_chunk_size=EDGE_CHUNK)
    out = timed("load_graph", lambda: load_graph(spark, schema, spec, scratch.folder("graph"), options).path)
    timed("read_back", lambda: run(StoredGraph(spark, out).edges(CONTAINS)))
    scratch.discard()
    found = re.search(r"sf([0-9.]+)", FOLDER)
    print(
        json.dumps(
            {
                "metric": "graph load stages, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
