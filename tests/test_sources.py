"""Scans: dialects, positions, partitions, pruning, unions and casts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftgraph.functions.types import cast_to
from weftgraph.operators import checks
from weftgraph.sources import read_inputs, side_by_side
from weftgraph.sources.files import count_lines, read_csv
from weftgraph.sources.tables import read_table, table_and_partitions
from weftgraph.spec import DataSource, FieldPlan, SpecError

INT, TEXT, REAL = "DT_SIGNED_INT64", "DT_STRING", "DT_DOUBLE"


def fields(*columns):
    return [FieldPlan(c, n, t, i) for c, n, t, i in columns]


THREE = fields(("k", "k", INT, 0), ("n", "n", TEXT, 1), ("w", "w", REAL, 2))


def csv(spark, folder, text, plan=THREE, **options):
    path = folder / "data.csv"
    path.write_text(text)
    return [tuple(r) for r in read_csv(spark, [str(path)], plan, options).collect()]


def test_columns_bind_by_position(spark, tmp_path):
    assert csv(spark, tmp_path, "x|y|z\n1|a|0.5") == [(1, "a", 0.5)]


def test_header_and_delimiter(spark, tmp_path):
    assert csv(spark, tmp_path, "1,a,0.5\n2,b,1", delimiter=",", header_row="false") == [(1, "a", 0.5), (2, "b", 1.0)]
    assert csv(spark, tmp_path, "1|a|0.5\n2|b|1", header_row="TRUE") == [(2, "b", 1.0)]
    assert csv(spark, tmp_path, "1|a|0.5\n2|b|1", header_row="True") == [(1, "a", 0.5), (2, "b", 1.0)]


def test_surplus_and_missing_cells(spark, tmp_path):
    assert csv(spark, tmp_path, "h|h|h|h\n1|a|0.5|9\n2|b") == [(1, "a", 0.5), (2, "b", None)]


def test_malformed_cells_become_null(spark, tmp_path):
    assert csv(spark, tmp_path, "h|h|h\n1|a|oops\noops|b|1") == [(1, "a", None), (None, "b", 1.0)]
    with pytest.raises(Exception, match="MALFORMED"):
        csv(spark, tmp_path, "h|h|h\n1|a|oops", mode="FAILFAST")


def test_quoting(spark, tmp_path):
    line = 'h|h|h\n1|"x|1.0'
    assert csv(spark, tmp_path, line, quoting="false") == [(1, '"x', 1.0)]
    assert csv(spark, tmp_path, 'h|h|h\n1|"x|y"|1.0') == [(1, "x|y", 1.0)]
    assert csv(spark, tmp_path, "h|h|h\n1|'x|y'|1.0", quote_char="'") == [(1, "x|y", 1.0)]
    assert csv(spark, tmp_path, 'h|h|h\n1|"x""y"|1.0', double_quote="true") == [(1, 'x"y', 1.0)]
    assert csv(spark, tmp_path, 'h|h|h\n1|"x^"y"|1.0', escape_char="^") == [(1, 'x"y', 1.0)]


def test_index_binding_with_gaps(spark, tmp_path):
    plan = fields(("w", "w", REAL, 3), ("k", "k", INT, 1))
    assert csv(spark, tmp_path, "a|b|c|d\nx|7|y|0.5", plan) == [(0.5, 7)]


def test_dotted_names(spark, tmp_path):
    plan = fields(("person.id", "src", INT, 0), ("person.id2", "dst", INT, 1))
    assert csv(spark, tmp_path, "a|b\n1|2", plan) == [(1, 2)]


def test_inputs_are_all_read(spark, tmp_path):
    for name, text in (("a.csv", "h|h|h\n1|a|1"), ("b.csv", "h|h|h\n2|b|2\n1|a|1")):
        (tmp_path / name).write_text(text)
    source = DataSource("file", str(tmp_path))
    assert read_inputs(spark, source, ["a.csv", "b.csv"], THREE).count() == 3
    assert read_inputs(spark, source, ["a.csv", "a.csv", "b.csv"], THREE).count() == 4
    scans = read_inputs(spark, source, ["a.csv", "b.csv"], THREE)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in scans


@pytest.mark.parametrize(
    "name, expected",
    [
        ("tbl", ("tbl", [])),
        ("proj/tbl", ("tbl", [])),
        ("tbl/ds=1", ("tbl", [("ds", "1")])),
        ("proj/tbl/ds=a=b", ("tbl", [("ds", "a=b")])),
        ("proj/tbl/ds=20240109/hr=3", ("tbl", [("ds", "20240109"), ("hr", "3")])),
    ],
)
def test_table_inputs(name, expected):
    assert table_and_partitions(name) == expected


@pytest.mark.parametrize("name", ["", "a/b/c", "proj/tbl/ds=", "proj/tbl/=1", "ds=1", "/tbl", "a/ds=1/tbl"])
def test_wrong_table_inputs(name):
    with pytest.raises(SpecError):
        table_and_partitions(name)


@pytest.fixture(scope="module")
def partitioned(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warehouse") / "facts")
    rows = [(i, float(i), f"t{i}", "2024010%d" % (i % 4) if i % 5 else "old", i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "id bigint, w double, extra string, ds string, hr int")
    frame.write.partitionBy("ds", "hr").parquet(path)
    schema = frame.schema
    spark.read.schema(schema).parquet(path).createOrReplaceTempView("facts")
    return rows


def test_partition_values_are_typed(spark, partitioned):
    got = read_table(spark, "proj/facts/ds=20240101").select("id").collect()
    assert sorted(r["id"] for r in got) == [r[0] for r in partitioned if r[3] == "20240101"]
    got = read_table(spark, "facts/ds=old/hr=1").select("id").collect()
    assert sorted(r["id"] for r in got) == [r[0] for r in partitioned if r[3] == "old" and r[4] == 1]


def test_partitions_and_columns_are_pruned(spark, partitioned):
    plan = fields(("id", "id", INT, 0), ("w", "weight", REAL, 0))
    frame = read_inputs(spark, DataSource("table", "proj"), ["facts/ds=20240101/hr=1"], plan)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "(ds" in text.split("PartitionFilters")[1] and "= 20240101)" in text
    assert "cast(ds" not in text
    assert "ReadSchema: struct<id:bigint,w:double>" in text
    assert frame.columns == ["id", "weight"]


def test_casts(spark, tmp_path):
    spark.sql("SELECT '12' AS a, 'x' AS b, 1 AS c, 2.5D AS d").createOrReplaceTempView("loose")
    plan = fields(("a", "a", INT, 0), ("c", "c", "DT_BOOL", 0), ("d", "d", TEXT, 0), ("c", "e", "DT_UNSIGNED_INT8", 0))
    frame = read_inputs(spark, DataSource("table"), ["loose"], plan)
    assert [f.dataType.simpleString() for f in frame.schema] == ["bigint", "boolean", "string", "int"]
    assert tuple(frame.first()) == (12, True, "2.5", 1)
    bad = fields(("b", "b", INT, 0))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_inputs(spark, DataSource("table"), ["loose"], bad).collect()
    assert read_inputs(spark, DataSource("table"), ["loose"], bad, "null").first()["b"] is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_millis_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.sql(
            "SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123456' AS a, DATE'1969-12-31' AS b, "
            "TIMESTAMP_NTZ'1969-12-31 23:59:59.4999' AS c, timestamp_millis(1710037800123) AS d, "
            "TIMESTAMP_NTZ'9999-12-31 23:59:59.999' AS e"
        )
        row = frame.select(*[cast_to(F.col(f.name), f.dataType, INT).alias(f.name) for f in frame.schema]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (1710037800123, -86_400_000, -501, 1710037800123, 253402300799999)


def test_count_lines(spark, tmp_path):
    (tmp_path / "text").write_text("a\nb\n\nc")
    assert count_lines(spark, str(tmp_path / "text")).first()["lines"] == 4


def test_checks_return_the_offending_rows(spark):
    frame = spark.createDataFrame(
        [(1, 255, "5"), (2, 256, "x"), (None, -1, None), (2, None, "6"), (2, 0, "7.5")], "k bigint, b int, t string"
    )
    assert checks.null_keys(frame, "k").count() == 1
    assert [tuple(r) for r in checks.duplicate_keys(frame, "k").collect()] == [(2, 3)]
    outside = checks.out_of_range(frame, {"b": "DT_UNSIGNED_INT8", "k": INT})
    assert sorted(r["b"] for r in outside.collect()) == [-1, 256]
    assert checks.out_of_range(frame, {"k": INT}).count() == 0
    lost = checks.lost_cells(frame, {"t": INT, "k": INT})
    assert sorted((r["t"], r["lost"]) for r in lost.collect()) == [("7.5", ["t"]), ("x", ["t"])]


CELLS = [FieldPlan("a", "a", "DT_BOOL"), FieldPlan("b", "b", "DT_SIGNED_INT32"), FieldPlan("c", "c", "DT_DOUBLE")]


def test_lost_cells_are_judged_by_the_parser(spark, tmp_path):
    (tmp_path / "cells.csv").write_text("a|b|c\ntrue|1|1.5\nyes|2|2\n1| 12 |x\n|| \nfalse|3|NaN")
    source = DataSource("file", str(tmp_path), "csv")
    both = side_by_side(spark, source, ["cells.csv"], CELLS)
    loaded = read_inputs(spark, source, ["cells.csv"], CELLS)
    assert [tuple(r["typed"])[:2] for r in both.collect()] == [tuple(r)[:2] for r in loaded.collect()]
    lost = [
        [n for n in "abc" if r["raw"][n] is not None and r["typed"][n] is None] for r in both.collect()
    ]
    assert lost == [[], ["a"], ["a", "b", "c"], ["c"], []]


def test_csv_cells_can_stop_a_load(spark, tmp_path):
    (tmp_path / "good.csv").write_text("a|b|c|surplus\ntrue|1|1.5|x\n||")
    (tmp_path / "bad.csv").write_text("a|b|c\ntrue|one|1.5")
    source = DataSource("file", str(tmp_path), "csv")
    good = read_inputs(spark, source, ["good.csv"], CELLS, "raise").collect()
    assert [tuple(r) for r in good] == [(True, 1, 1.5), (None, None, None)]
    assert [tuple(r) for r in read_inputs(spark, source, ["bad.csv"], CELLS).collect()] == [(True, None, 1.5)]
    with pytest.raises(Exception, match="b is no DT_SIGNED_INT32"):
        read_inputs(spark, source, ["bad.csv"], CELLS, "raise").collect()


def test_a_csv_column_read_under_two_types(spark, tmp_path):
    (tmp_path / "codes.csv").write_text("code\n007\nx1")
    fields = [FieldPlan("code", "text", "DT_STRING"), FieldPlan("code", "number", INT)]
    frame = read_inputs(spark, DataSource("file", str(tmp_path), "csv"), ["codes.csv"], fields)
    assert [tuple(r) for r in frame.collect()] == [("007", 7), ("x1", None)]


def test_lost_cells_of_a_csv(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text("h|h|h\n1|a|oops\n2|b|\noops|c|1")
    raw = read_csv(spark, [str(path)], THREE, {}, as_text=True)
    lost = checks.lost_cells(raw, {f.column: f.type for f in THREE})
    assert sorted((r["n"], r["lost"]) for r in lost.collect()) == [("a", ["w"]), ("c", ["k"])]
