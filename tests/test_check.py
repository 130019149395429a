from __future__ import annotations

import modern
from weftgraph import check_sources
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


def test_sources_are_checked_by_label_and_triplet(spark, tmp_path):
    modern.write_files(tmp_path)
    with open(tmp_path / "person.csv", "a") as file:
        file.write("\n|nobody|1\n1|again|x\noops|c|")
    with open(tmp_path / "knows.csv", "a") as file:
        file.write("\n1||0.5\n1|2|heavy")
    found = {(r["name"], r["check"]): r["rows"] for r in check_sources(spark, modern.schema(), modern.spec(tmp_path)).collect()}
    assert {k: n for k, n in found.items() if n} == {
        ("person", "null_keys"): 2,
        ("person", "duplicate_keys"): 1,
        ("person", "lost_cells"): 2,
        ("person-knows->person", "null_keys"): 1,
        ("person-knows->person", "lost_cells"): 1,
    }
    assert len(found) == 2 * 4 + 2 * 3


def test_rows_are_read_once_for_all_checks(spark, tmp_path):
    for name, columns in (("v", "id AS k, id AS p"), ("e", "id AS a, id AS b")):
        spark.range(5).selectExpr(*columns.split(", ")).write.parquet(str(tmp_path / name))
        spark.read.parquet(str(tmp_path / name)).createOrReplaceTempView(f"once_{name}")
    number = "DT_SIGNED_INT64"
    properties = (Property("k", number), Property("p", number))
    schema = GraphSchema(
        "g",
        (VertexType("V", properties, ("k",)), VertexType("W", properties, ("k",))),
        (EdgeType("E", (EdgePair("V", "W"),)),),
    )
    edge = EdgeMapping(Triplet("V", "E", "W"), ("once_e",), (ColumnMapping("a"),), (ColumnMapping("b"),))
    vertices = (VertexMapping("V", ("once_v",)), VertexMapping("W", ("once_v",)))
    found = check_sources(spark, schema, ImportSpec("g", DataSource("table"), vertices, (edge,)))
    # Two labels: their rows, and their keys for repeats; one triplet: its rows.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 5
    assert {r["check"]: r["rows"] for r in found.where("name = 'V'").collect()} == {
        "null_keys": 0,
        "out_of_range": 0,
        "lost_cells": 0,
        "duplicate_keys": 0,
    }
