"""One query per operator over the given tables, with the SQL that must agree.

A query takes (spark, folder of the tables) and returns a frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.operators import checks
from weftgraph.operators.adjacency import adjacency, keep_edges, offsets
from weftgraph.operators.endpoints import dangling_edges, heavy_keys, resolved_edges
from weftgraph.operators.index import chunk_of, key_index, vertex_index
from weftgraph.operators.mapping import edge_frame, vertex_frame
from weftgraph.operators.ranking import numbered
from weftgraph.plans.check import check_sources, malformed_rows
from weftgraph.plans.load import LoadOptions, load_edges, load_graph, load_vertices
from weftgraph.plans.table_graph import EDGES, INT64, VERTICES, register_tables, table_schema, table_spec
from weftgraph.scratch import Scratch
from weftgraph.sinks.graph_files import StoredGraph
from weftgraph.sources.files import count_lines
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

PLACED = Triplet("Customer", "Placed", "Order")
BUILDING_PLACED = Triplet("BuildingCustomer", "Placed", "Order")
CONTAINS = Triplet("Order", "Contains", "Part")
SOLD_BY = Triplet("Part", "SoldBy", "Supplier")
BESIDE = Triplet("Part", "Beside", "Part")
LIVES_IN = Triplet("Customer", "LivesIn", "Nation")
WITHIN = Triplet("Nation", "Within", "Region")

VERTEX_CHUNK = 1000
EDGE_CHUNK = 2500
# Small enough that the given tables are cut into many ranges.
SMALL_RANGE = 8192

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(sql: str) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        def on_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
            register_tables(spark, sf_dir)
            return run(spark, sf_dir)

        _QUERIES[run.__name__] = on_tables
        _SQL[run.__name__] = sql
        return run

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- projections -----------------------------------------------------------------------------------------------


def _vertices(spark: SparkSession, label: str, naming: str = "property") -> DataFrame:
    return vertex_frame(spark, table_schema(), table_spec([label]), label, naming).frame


def _edges(spark: SparkSession, triplet: Triplet) -> DataFrame:
    labels = list(dict.fromkeys([triplet.source, triplet.destination]))
    return edge_frame(spark, table_schema(), table_spec(labels, [triplet]), triplet).frame


@_query(
    "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment "
    "FROM customer"
)
def vertex_mapped(spark, sf_dir):
    return _vertices(spark, "Customer")


@_query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def vertex_default_mapping(spark, sf_dir):
    properties = (
        Property("s_suppkey", "DT_SIGNED_INT64"),
        Property("s_name", "DT_STRING"),
        Property("s_nationkey", "DT_SIGNED_INT32"),
        Property("s_acctbal", "DT_DOUBLE"),
    )
    schema = GraphSchema("defaults", (VertexType("Supplier", properties, ("s_suppkey",)),))
    spec = ImportSpec("defaults", DataSource("table"), (VertexMapping("Supplier", ("supplier",)),))
    return vertex_frame(spark, schema, spec, "Supplier").frame


@_query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def vertex_source_naming(spark, sf_dir):
    return _vertices(spark, "Customer", naming="source")


@_query(
    "SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice AS price, epoch_ms(o_orderdate) AS placed FROM orders"
)
def edge_mapped(spark, sf_dir):
    return _edges(spark, PLACED)


@_query("SELECT n_nationkey AS src, n_regionkey AS dst FROM nation")
def edge_no_properties(spark, sf_dir):
    return _edges(spark, WITHIN)


@_query("SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice, o_orderpriority FROM orders")
def edge_default_mapping(spark, sf_dir):
    properties = (Property("o_totalprice", "DT_DOUBLE"), Property("o_orderpriority", "DT_STRING"))
    schema = replace(
        table_schema(), edge_types=(EdgeType("Placed", (EdgePair("Customer", "Order"),), properties),)
    )
    mapping = EdgeMapping(PLACED, ("orders",), (ColumnMapping("o_custkey"),), (ColumnMapping("o_orderkey"),))
    spec = replace(table_spec(["Customer", "Order"]), edges=(mapping,))
    return edge_frame(spark, schema, spec, PLACED).frame


@_query(
    "SELECT l_orderkey AS src, l_partkey AS dst, l_linenumber AS line, l_quantity AS quantity, "
    "l_extendedprice AS price, epoch_ms(l_shipdate) AS shipped FROM lineitem"
)
def edge_epoch_millis(spark, sf_dir):
    return _edges(spark, CONTAINS)


@_query(
    "SELECT CAST(doc_id AS BIGINT) AS id, CAST(quality AS INTEGER) AS quality, CAST(toxic AS BOOLEAN) AS toxic, "
    "CAST(doc_id AS DOUBLE) AS weight, CAST(doc_id AS VARCHAR) AS name FROM labels"
)
def type_widening(spark, sf_dir):
    columns = (
        ("doc_id", "id", "DT_SIGNED_INT64"),
        ("quality", "quality", "DT_UNSIGNED_INT8"),
        ("toxic", "toxic", "DT_BOOL"),
        ("doc_id", "weight", "DT_DOUBLE"),
        ("doc_id", "name", "DT_STRING"),
    )
    schema = GraphSchema("types", (VertexType("Rated", tuple(Property(p, t) for _, p, t in columns), ("id",)),))
    mappings = tuple(ColumnMapping(c, p) for c, p, _ in columns)
    spec = ImportSpec("types", DataSource("table"), (VertexMapping("Rated", ("labels",), mappings),))
    return vertex_frame(spark, schema, spec, "Rated").frame


# --- scans -----------------------------------------------------------------------------------------------------

_LINE_TYPES = (
    Property("line", "DT_SIGNED_INT16"),
    Property("quantity", "DT_DOUBLE"),
    Property("flag", "DT_STRING"),
)
_LINE_SQL = (
    "SELECT l_orderkey AS src, l_partkey AS dst, l_linenumber AS line, l_quantity AS quantity, l_returnflag AS flag "
    "FROM lineitem"
)


def _line_edges(spark: SparkSession, source: DataSource, inputs: tuple[str, ...], indexes: list[int]) -> DataFrame:
    """Order-Contains->Part read from files; ``indexes`` are the positions of the five columns."""
    schema = replace(table_schema(), edge_types=(EdgeType("Contains", (EdgePair("Order", "Part"),), _LINE_TYPES),))
    columns = ("l_linenumber", "l_quantity", "l_returnflag")
    mapping = EdgeMapping(
        CONTAINS,
        inputs,
        (ColumnMapping("l_orderkey", index=indexes[0]),),
        (ColumnMapping("l_partkey", index=indexes[1]),),
        tuple(ColumnMapping(c, p.name, i) for c, p, i in zip(columns, _LINE_TYPES, indexes[2:])),
    )
    spec = ImportSpec("files", source, (), (mapping,))
    return edge_frame(spark, schema, spec, CONTAINS).frame


def _line_file(spark: SparkSession, columns: list[str], file_format: str, **options: object) -> DataSource:
    """The line items written to files of the given format."""
    location = Scratch(spark).path
    spark.table("lineitem").select(*columns).write.options(**options).format(file_format).save(f"{location}/lines")
    return DataSource("file", location, file_format)


@_query(_LINE_SQL)
def csv_scan(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"]
    source = _line_file(spark, columns, "csv", sep="|", header=True)
    return _line_edges(spark, source, ("lines",), [0, 0, 0, 0, 0])


@_query(_LINE_SQL)
def csv_surplus_columns(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax", "l_linestatus"]
    source = _line_file(spark, columns, "csv", sep=";", header=False)
    source = replace(source, options={"delimiter": ";", "header_row": "false"})
    return _line_edges(spark, source, ("lines",), [0, 1, 2, 3, 4])


@_query(_LINE_SQL)
def csv_by_index(spark, sf_dir):
    columns = ["l_returnflag", "l_tax", "l_quantity", "l_partkey", "l_discount", "l_linenumber", "l_orderkey"]
    source = _line_file(spark, columns, "csv", sep="|", header=True)
    return _line_edges(spark, source, ("lines",), [6, 3, 5, 2, 0])


@_query(_LINE_SQL)
def parquet_scan(spark, sf_dir):
    return _line_edges(spark, DataSource("file", sf_dir, "parquet"), ("lineitem.parquet",), [0] * 5)


@_query(_LINE_SQL)
def orc_scan(spark, sf_dir):
    columns = ["l_returnflag", "l_partkey", "l_orderkey", "l_quantity", "l_linenumber"]
    return _line_edges(spark, _line_file(spark, columns, "orc"), ("lines",), [0] * 5)


def _cells(spark: SparkSession, columns: dict[str, str], types: dict[str, tuple[str, str]]) -> tuple[GraphSchema, ImportSpec]:
    """Expressions over the line items written as CSV, and a label that reads them: property to (column, type)."""
    location = Scratch(spark).path
    as_they_are = {"sep": "|", "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    cells = spark.table("lineitem").selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
    cells.write.options(**as_they_are).csv(f"{location}/cells")
    properties = tuple(Property(p, t) for p, (_, t) in types.items())
    schema = GraphSchema("cells", (VertexType("Cell", properties, ("id",)),))
    order = list(columns)
    mappings = tuple(ColumnMapping(c, p, order.index(c)) for p, (c, _) in types.items())
    source = DataSource("file", location, "csv")
    return schema, ImportSpec("cells", source, (VertexMapping("Cell", ("cells",), mappings),))


@_query(
    "SELECT 'Cell' AS name, 'null_keys' AS \"check\", count(*) FILTER (l_orderkey IS NULL) AS rows FROM lineitem "
    "UNION ALL SELECT 'Cell', 'out_of_range', 0 UNION ALL SELECT 'Cell', 'duplicate_keys', count(*) FROM "
    "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) "
    "UNION ALL SELECT 'Cell', 'lost_cells', count(*) FILTER (l_linenumber IN (2, 3, 4)) FROM lineitem"
)
def csv_lost_cells(spark, sf_dir):
    columns = {
        "id": "l_orderkey * 10 + l_linenumber",
        "flag": "CASE l_linenumber WHEN 2 THEN 'yes' WHEN 1 THEN 'true' ELSE 'false' END",
        "part": "CASE WHEN l_linenumber = 3 THEN concat(' ', l_partkey, ' ') ELSE string(l_partkey) END",
        "price": "CASE WHEN l_linenumber = 4 THEN 'n/a' ELSE string(l_extendedprice) END",
    }
    types = {"id": INT64, "flag": "DT_BOOL", "part": "DT_SIGNED_INT32", "price": "DT_DOUBLE"}
    return check_sources(spark, *_cells(spark, columns, {p: (p, t) for p, t in types.items()}))


@_query(
    "SELECT l_orderkey * 10 + l_linenumber AS id, lpad(CAST(l_partkey AS VARCHAR), 8, '0') AS code, l_partkey AS part "
    "FROM lineitem"
)
def csv_shared_column(spark, sf_dir):
    columns = {"id": "l_orderkey * 10 + l_linenumber", "code": "lpad(l_partkey, 8, '0')"}
    types = {"id": ("id", INT64), "code": ("code", "DT_STRING"), "part": ("code", INT64)}
    schema, spec = _cells(spark, columns, types)
    shared = tuple(replace(m, index=0) for m in spec.vertices[0].columns)
    spec = replace(spec, vertices=(replace(spec.vertices[0], columns=shared),))
    return vertex_frame(spark, schema, spec, "Cell").frame


@_query(
    "SELECT 'Cell' AS name, 'malformed_rows' AS \"check\", count(*) FILTER (l_linenumber IN (2, 3, 4)) AS rows FROM lineitem "
    "UNION ALL SELECT 'Cell', 'null_keys', count(*) FILTER (l_orderkey IS NULL) FROM lineitem "
    "UNION ALL SELECT 'Cell', 'out_of_range', 0 "
    "UNION ALL SELECT 'Cell', 'lost_cells', count(*) FILTER (l_linenumber = 6) FROM lineitem "
    "UNION ALL SELECT 'Cell', 'duplicate_keys', count(*) FROM "
    "(SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) "
    "UNION ALL SELECT 'line', 'short_or_long', count(*) FROM lineitem WHERE l_linenumber IN (2, 3) "
    "UNION ALL SELECT 'line', 'unclosed_quote', count(*) FROM lineitem WHERE l_linenumber = 4"
)
def csv_malformed_rows(spark, sf_dir):
    location = Scratch(spark).path
    key, part, flag = "l_orderkey * 10 + l_linenumber", "l_partkey", "l_returnflag"
    lines = (
        f"CASE l_linenumber WHEN 2 THEN concat_ws('|', {key}, {part}) WHEN 3 THEN concat_ws('|', {key}, {part}, {flag}, 'more') "
        f"WHEN 4 THEN concat({key}, '|\"', {part}, '|', {flag}) WHEN 5 THEN concat({key}, '|', {part}, '|\"', {flag}) "
        f"WHEN 6 THEN concat_ws('|', {key}, 'n/a', {flag}) ELSE concat_ws('|', {key}, {part}, {flag}) END"
    )
    # Whole lines as the only column of a file, whose name is then the header.
    whole = {"header": True, "sep": "\u0001", "quote": "", "escapeQuotes": False}
    spark.table("lineitem").select(F.expr(lines).alias("id|part|flag")).write.options(**whole).csv(f"{location}/lines")
    types = {"id": INT64, "part": INT64, "flag": "DT_STRING"}
    schema = GraphSchema("cells", (VertexType("Cell", tuple(Property(p, t) for p, t in types.items()), ("id",)),))
    mapping = VertexMapping("Cell", ("lines",), tuple(ColumnMapping(p, p, i) for i, p in enumerate(types)))
    spec = ImportSpec("cells", DataSource("file", location, "csv"), (mapping,))
    faults = malformed_rows(spark, schema, spec, "Cell").groupBy(F.lit("line").alias("name"), F.col("fault").alias("check"))
    return check_sources(spark, schema, spec, malformed=True).unionByName(faults.agg(F.count(F.lit(1)).alias("rows")))


@_query("SELECT count(*) AS lines FROM lineitem")
def text_line_count(spark, sf_dir):
    source = _line_file(spark, ["l_orderkey", "l_partkey"], "csv", header=False)
    return count_lines(spark, f"{source.location}/lines")


# --- filters and unions ----------------------------------------------------------------------------------------


def _order_vertices(spark: SparkSession, *inputs: str) -> DataFrame:
    spec = table_spec(["Order"])
    return vertex_frame(spark, table_schema(), replace(spec, vertices=(replace(spec.vertices[0], inputs=inputs),)), "Order").frame


_ORDER_SQL = (
    "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, epoch_ms(o_orderdate) AS placed, "
    "o_orderpriority AS priority FROM orders"
)


@_query(f"{_ORDER_SQL} WHERE o_orderstatus = 'F'")
def partition_filter(spark, sf_dir):
    return _order_vertices(spark, "project/orders/o_orderstatus=F")


@_query(f"{_ORDER_SQL} WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def partition_filter_two_level(spark, sf_dir):
    return _order_vertices(spark, "project/orders/o_orderstatus=F/o_orderpriority=1-URGENT")


@_query(
    f"{_ORDER_SQL} WHERE o_orderstatus = 'F' UNION ALL {_ORDER_SQL} WHERE o_orderstatus = 'O' "
    f"UNION ALL {_ORDER_SQL}"
)
def multi_input_union(spark, sf_dir):
    return _order_vertices(spark, "orders/o_orderstatus=F", "orders/o_orderstatus=O", "project/orders")


@_query(
    "SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice AS price, epoch_ms(o_orderdate) AS placed FROM orders "
    "WHERE o_orderstatus = 'P' UNION ALL "
    "SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice AS price, epoch_ms(o_orderdate) AS placed FROM orders"
)
def multi_input_union_edges(spark, sf_dir):
    spec = table_spec(["Customer", "Order"], [PLACED])
    edges = replace(spec.edges[0], inputs=("orders/o_orderstatus=P", "orders"))
    return edge_frame(spark, table_schema(), replace(spec, edges=(edges,)), PLACED).frame


# --- counts and checks -----------------------------------------------------------------------------------------


def _counts_sql() -> str:
    building = " WHERE c_mktsegment = 'BUILDING'"
    parts = [
        f"SELECT '{label}' AS name, count(*) AS rows FROM {table}{building if label == 'BuildingCustomer' else ''}"
        for label, (table, _) in VERTICES.items()
    ]
    parts += [f"SELECT '{t}' AS name, count(*) AS rows FROM {table}" for t, (table, *_) in EDGES.items()]
    return " UNION ALL ".join(parts)


@_query(_counts_sql())
def load_counts(spark, sf_dir):
    spec = table_spec(list(VERTICES), list(EDGES))
    frames = {label: v.frame for label, v in load_vertices(spark, table_schema(), spec).items()}
    frames |= {str(t): e.frame for t, e in load_edges(spark, table_schema(), spec).items()}
    return checks.row_counts(frames)


@_query("SELECT l_orderkey AS id, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    schema = GraphSchema("lines", (VertexType("Line", (Property("id", "DT_SIGNED_INT64"),), ("id",)),))
    mapping = VertexMapping("Line", ("lineitem",), (ColumnMapping("l_orderkey", "id"),))
    spec = ImportSpec("lines", DataSource("table"), (mapping,))
    return checks.duplicate_keys(vertex_frame(spark, schema, spec, "Line").frame, "id")


@_query(
    "SELECT o_orderkey AS order_id, CAST(NULL AS BIGINT) AS id FROM orders "
    "LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') b ON o_custkey = b.c_custkey "
    "WHERE b.c_custkey IS NULL"
)
def null_keys(spark, sf_dir):
    building = _vertices(spark, "BuildingCustomer").select("id")
    orders = spark.table("orders").select("o_custkey", F.col("o_orderkey").alias("order_id"))
    owned = orders.join(building, orders["o_custkey"] == building["id"], "left").select("order_id", "id")
    return checks.null_keys(owned, "id")


@_query(
    "SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS BIGINT) AS price FROM lineitem "
    "WHERE round(l_extendedprice) NOT BETWEEN 0 AND 65535"
)
def out_of_range_values(spark, sf_dir):
    lines = spark.table("lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_extendedprice").cast("bigint").alias("price")
    )
    return checks.out_of_range(lines, {"price": "DT_UNSIGNED_INT16", "l_linenumber": "DT_UNSIGNED_INT8"})


@_query(
    "SELECT event_id, props FROM events WHERE props IS NOT NULL AND try_cast(props AS BIGINT) IS NULL"
)
def lost_cells(spark, sf_dir):
    return checks.lost_cells(spark.table("events").select("event_id", "props"), {"props": "DT_SIGNED_INT64"}).drop(
        "lost"
    )


@_query(
    "SELECT 'Line' AS name, 'null_keys' AS \"check\", count(*) AS rows FROM lineitem WHERE l_orderkey IS NULL "
    "UNION ALL SELECT 'Line', 'duplicate_keys', count(*) FROM "
    "(SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) "
    "UNION ALL SELECT 'Line', 'out_of_range', count(*) FROM lineitem WHERE trunc(l_extendedprice) NOT BETWEEN 0 AND 65535 "
    "UNION ALL SELECT 'Line', 'lost_cells', count(*) FROM lineitem WHERE l_returnflag IS NOT NULL "
    "AND try_cast(l_returnflag AS BIGINT) IS NULL"
)
def source_checks(spark, sf_dir):
    columns = (
        ("l_orderkey", "id", INT64),
        ("l_extendedprice", "price", "DT_UNSIGNED_INT16"),
        ("l_returnflag", "flag", INT64),
    )
    schema = GraphSchema("lines", (VertexType("Line", tuple(Property(p, t) for _, p, t in columns), ("id",)),))
    mapping = VertexMapping("Line", ("lineitem",), tuple(ColumnMapping(c, p) for c, p, _ in columns))
    return check_sources(spark, schema, ImportSpec("lines", DataSource("table"), (mapping,)))


# --- index and endpoints ---------------------------------------------------------------------------------------

_BUILDING = (
    "(SELECT c_custkey AS id, c_name AS name, row_number() OVER (ORDER BY c_custkey) - 1 AS vid "
    "FROM customer WHERE c_mktsegment = 'BUILDING')"
)


def _ranked_sql(table: str, key: str) -> str:
    return f"(SELECT {key} AS id, row_number() OVER (ORDER BY {key}) - 1 AS vid FROM {table})"


def _indexed(spark: SparkSession, label: str, rows_per_range: int | None = None) -> DataFrame:
    vertex = vertex_frame(spark, table_schema(), table_spec([label]), label)
    return vertex_index(vertex.frame, vertex.key, Scratch(spark), rows_per_range)[0]


def _key_index(spark: SparkSession, label: str) -> DataFrame:
    vertex = vertex_frame(spark, table_schema(), table_spec([label]), label)
    return key_index(vertex.frame, vertex.key, Scratch(spark))


@_query(f"SELECT id, name, CAST(vid AS BIGINT) AS vid FROM {_BUILDING}")
def vertex_index_sparse(spark, sf_dir):
    return _indexed(spark, "BuildingCustomer")


@_query(
    "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price, epoch_ms(o_orderdate) AS placed, "
    "o_orderpriority AS priority, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS vid FROM orders"
)
def vertex_index_in_ranges(spark, sf_dir):
    return _indexed(spark, "Order", SMALL_RANGE // 8)


@_query("SELECT url, page_id AS page, CAST(row_number() OVER (ORDER BY url) - 1 AS BIGINT) AS vid FROM pages")
def vertex_index_text_key(spark, sf_dir):
    # The SQL numbers every row, and urls of pages repeat: no uniqueness is asked of the key.
    # Nulls last as in ORDER BY url; pages of one url in the order of their page.
    vertex = vertex_frame(spark, table_schema(), table_spec(["Page"]), "Page")
    frame = vertex.frame.withColumn("url_is_null", F.col(vertex.key).isNull())
    indexed = numbered(frame, ["url_is_null", vertex.key, "page"], "vid", Scratch(spark))
    return indexed.drop("url_is_null")


@_query(
    "SELECT l_partkey AS id, CAST(row_number() OVER (ORDER BY l_partkey) - 1 AS BIGINT) AS vid "
    "FROM (SELECT DISTINCT l_partkey FROM lineitem)"
)
def key_index_of_repeated_keys(spark, sf_dir):
    return key_index(spark.table("lineitem").select(F.col("l_partkey").alias("id")), "id", Scratch(spark))


@_query(
    f"SELECT CAST((row_number() OVER (ORDER BY c_custkey) - 1) // {VERTEX_CHUNK} AS BIGINT) AS vertex_chunk, "
    "CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS vid, c_custkey AS id, c_name AS name, "
    "c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer"
)
def vertex_chunks(spark, sf_dir):
    indexed = _indexed(spark, "Customer")
    return indexed.select(chunk_of("vid", VERTEX_CHUNK), *indexed.columns)


def _resolved(spark: SparkSession, triplet: Triplet) -> DataFrame:
    source = _key_index(spark, triplet.source)
    destination = source if triplet.source == triplet.destination else _key_index(spark, triplet.destination)
    return resolved_edges(_edges(spark, triplet), "src", "dst", source, destination)


_CONTAINS_SQL = (
    "(SELECT s.vid AS src_vid, d.vid AS dst_vid, l_linenumber AS line, l_quantity AS quantity, "
    "l_extendedprice AS price, epoch_ms(l_shipdate) AS shipped FROM lineitem "
    f"JOIN {_ranked_sql('orders', 'o_orderkey')} s ON l_orderkey = s.id "
    f"JOIN {_ranked_sql('part', 'p_partkey')} d ON l_partkey = d.id)"
)


@_query(
    "SELECT CAST(s.vid AS BIGINT) AS src_vid, CAST(d.vid AS BIGINT) AS dst_vid, o_totalprice AS price, "
    "epoch_ms(o_orderdate) AS placed FROM orders "
    f"JOIN {_BUILDING} s ON o_custkey = s.id JOIN {_ranked_sql('orders', 'o_orderkey')} d ON o_orderkey = d.id"
)
def edge_resolved(spark, sf_dir):
    return _resolved(spark, BUILDING_PLACED)


@_query(
    "SELECT CAST(s.vid AS BIGINT) AS src_vid, CAST(d.vid AS BIGINT) AS dst_vid, l_returnflag AS flag FROM lineitem "
    f"JOIN {_ranked_sql('part', 'p_partkey')} s ON l_partkey = s.id "
    f"JOIN {_ranked_sql('part', 'p_partkey')} d ON l_suppkey = d.id"
)
def edge_resolved_one_label(spark, sf_dir):
    return _resolved(spark, BESIDE)


# A third of a segment's orders come from its first customer.
_HUB_ORDERS = (
    "SELECT if(o_orderkey % 3 = 0, hub, o_custkey) AS {src}, o_orderkey AS {dst}, o_totalprice AS price FROM orders "
    "JOIN customer ON o_custkey = c_custkey "
    "JOIN (SELECT c_mktsegment AS segment, min(c_custkey) AS hub FROM customer GROUP BY c_mktsegment) h "
    "ON c_mktsegment = segment"
)


@_query(
    "SELECT CAST(s.vid AS BIGINT) AS src_vid, CAST(d.vid AS BIGINT) AS dst_vid, price FROM "
    f"({_HUB_ORDERS.format(src='src', dst='dst')}) e "
    f"JOIN {_ranked_sql('customer', 'c_custkey')} s ON e.src = s.id JOIN {_ranked_sql('orders', 'o_orderkey')} d ON e.dst = d.id"
)
def edge_resolved_hubs(spark, sf_dir):
    edges = spark.sql(_HUB_ORDERS.format(src="src", dst="dst"))
    heavy = heavy_keys(edges, ["src", "dst"])
    return resolved_edges(edges, "src", "dst", _key_index(spark, "Customer"), _key_index(spark, "Order"), heavy)


@_query(
    "SELECT o_custkey AS src, o_orderkey AS dst, o_totalprice AS price, epoch_ms(o_orderdate) AS placed FROM orders "
    "WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
def dangling(spark, sf_dir):
    source, destination = _key_index(spark, "BuildingCustomer"), _key_index(spark, "Order")
    return dangling_edges(_edges(spark, BUILDING_PLACED), "src", "dst", source, destination)


# --- adjacency -------------------------------------------------------------------------------------------------


def _kept(spark: SparkSession, triplet: Triplet) -> DataFrame:
    return keep_edges(_resolved(spark, triplet), Scratch(spark))


def _adjacency_sql(by: str) -> str:
    near, far = ("src_vid", "dst_vid") if by == "source" else ("dst_vid", "src_vid")
    properties = ["line", "quantity", "price", "shipped"]
    order = ", ".join(f"{c} NULLS FIRST" for c in [near, far, *properties])
    return (
        f"SELECT CAST({near} // {VERTEX_CHUNK} AS BIGINT) AS vertex_chunk, CAST(pos // {EDGE_CHUNK} AS BIGINT) "
        "AS edge_chunk, CAST(pos AS BIGINT) AS pos, CAST(src_vid AS BIGINT) AS src_vid, "
        f"CAST(dst_vid AS BIGINT) AS dst_vid, {', '.join(properties)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {near} // {VERTEX_CHUNK} ORDER BY {order}) - 1 AS pos FROM {_CONTAINS_SQL})"
    )


@_query(_adjacency_sql("source"))
def adjacency_by_source(spark, sf_dir):
    return adjacency(_kept(spark, CONTAINS), "source", Scratch(spark), VERTEX_CHUNK, EDGE_CHUNK)


@_query(_adjacency_sql("destination"))
def adjacency_by_destination(spark, sf_dir):
    return adjacency(_kept(spark, CONTAINS), "destination", Scratch(spark), VERTEX_CHUNK, EDGE_CHUNK)


@_query(_adjacency_sql("destination"))
def adjacency_in_ranges(spark, sf_dir):
    return adjacency(_kept(spark, CONTAINS), "destination", Scratch(spark), VERTEX_CHUNK, EDGE_CHUNK, rows_per_range=SMALL_RANGE)


_SOLD_SQL = "SELECT l_partkey AS part, l_suppkey AS supplier, l_quantity AS quantity, l_discount AS discount FROM lineitem"


@_query(
    f"SELECT CAST(supplier // {VERTEX_CHUNK} AS BIGINT) AS vertex_chunk, CAST(pos // {EDGE_CHUNK} AS BIGINT) AS "
    "edge_chunk, count(*) AS edges, CAST(min(pos) AS BIGINT) AS first_pos, CAST(max(pos) AS BIGINT) AS last_pos, "
    "CAST(min(supplier) AS BIGINT) AS first_dst, CAST(max(supplier) AS BIGINT) AS last_dst FROM (SELECT *, "
    f"row_number() OVER (PARTITION BY supplier // {VERTEX_CHUNK} ORDER BY supplier, part, quantity, discount) - 1 AS "
    f"pos FROM ({_SOLD_SQL})) GROUP BY 1, 2"
)
def edge_chunks(spark, sf_dir):
    placed = adjacency(_kept(spark, SOLD_BY), "destination", Scratch(spark), VERTEX_CHUNK, EDGE_CHUNK)
    return placed.groupBy("vertex_chunk", "edge_chunk").agg(
        F.count(F.lit(1)).alias("edges"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.min("dst_vid").alias("first_dst"),
        F.max("dst_vid").alias("last_dst"),
    )


def _offsets_sql(edges: str, near: str, vertices: str, key: str) -> str:
    chunk = f"vid // {VERTEX_CHUNK}"
    return (
        f"WITH v AS (SELECT row_number() OVER (ORDER BY {key}) - 1 AS vid FROM {vertices}), "
        f"d AS (SELECT {near} AS vid, count(*) AS degree FROM {edges} GROUP BY 1), "
        f"f AS (SELECT v.vid, {chunk.replace('vid', 'v.vid')} AS c, coalesce(degree, 0) AS degree "
        "FROM v LEFT JOIN d ON v.vid = d.vid), "
        "o AS (SELECT c, vid, sum(degree) OVER (PARTITION BY c ORDER BY vid) - degree AS start FROM f) "
        'SELECT CAST(c AS BIGINT) AS vertex_chunk, CAST(vid AS BIGINT) AS vid, CAST(start AS BIGINT) AS "offset" FROM o '
        "UNION ALL SELECT CAST(c AS BIGINT), CAST(max(vid) + 1 AS BIGINT), CAST(sum(degree) AS BIGINT) FROM f GROUP BY c"
    )


def _offsets(spark: SparkSession, triplet: Triplet, by: str) -> DataFrame:
    label = triplet.source if by == "source" else triplet.destination
    return offsets(_kept(spark, triplet), by, _key_index(spark, label).count(), VERTEX_CHUNK)


@_query(_offsets_sql(_CONTAINS_SQL, "src_vid", "orders", "o_orderkey"))
def offsets_by_source(spark, sf_dir):
    return _offsets(spark, CONTAINS, "source")


@_query(_offsets_sql(_CONTAINS_SQL, "dst_vid", "part", "p_partkey"))
def offsets_by_destination(spark, sf_dir):
    return _offsets(spark, CONTAINS, "destination")


# --- whole loads -----------------------------------------------------------------------------------------------


def _loaded(spark: SparkSession, triplets: list[Triplet], **options: object) -> StoredGraph:
    labels = list(dict.fromkeys(label for t in triplets for label in (t.source, t.destination)))
    path = Scratch(spark).path
    chosen = LoadOptions(vertex_chunk_size=VERTEX_CHUNK, edge_chunk_size=EDGE_CHUNK, **options)
    load_graph(spark, table_schema(), table_spec(labels, triplets), path, chosen)
    return StoredGraph(spark, path)


@_query(_adjacency_sql("source"))
def graph_roundtrip(spark, sf_dir):
    return _loaded(spark, [CONTAINS]).edges(CONTAINS)


@_query(_adjacency_sql("destination"))
def graph_roundtrip_by_destination(spark, sf_dir):
    return _loaded(spark, [CONTAINS], file_format="parquet").edges(CONTAINS, "destination")


@_query(
    f"SELECT CAST(vid // {VERTEX_CHUNK} AS BIGINT) AS vertex_chunk, CAST(vid AS BIGINT) AS vid, id, name FROM {_BUILDING}"
)
def graph_roundtrip_vertices(spark, sf_dir):
    return _loaded(spark, [BUILDING_PLACED]).vertices("BuildingCustomer")


@_query(f"SELECT * FROM ({_adjacency_sql('source')}) WHERE vertex_chunk = 0 AND edge_chunk = 1")
def graph_roundtrip_edge_chunk(spark, sf_dir):
    return _loaded(spark, [CONTAINS], rows_per_range=SMALL_RANGE).edges(CONTAINS, "source", vertex_chunk=0, edge_chunk=1)


@_query(
    f"SELECT CAST(vid // {VERTEX_CHUNK} AS BIGINT) AS vertex_chunk, CAST(vid AS BIGINT) AS vid, c_custkey AS copies, "
    'c_nationkey AS _range, c_name AS _shift, c_acctbal AS "row", c_mktsegment AS lost FROM '
    "(SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS vid FROM customer)"
)
def graph_roundtrip_helper_names(spark, sf_dir):
    types = {
        "copies": ("c_custkey", INT64),
        "_range": ("c_nationkey", "DT_SIGNED_INT32"),
        "_shift": ("c_name", "DT_STRING"),
        "row": ("c_acctbal", "DT_DOUBLE"),
        "lost": ("c_mktsegment", "DT_STRING"),
    }
    properties = tuple(Property(p, t) for p, (_, t) in types.items())
    schema = GraphSchema("names", (VertexType("Customer", properties, ("copies",)),))
    mapping = VertexMapping("Customer", ("customer",), tuple(ColumnMapping(c, p) for p, (c, _) in types.items()))
    path = Scratch(spark).path
    options = LoadOptions(vertex_chunk_size=VERTEX_CHUNK, rows_per_range=SMALL_RANGE // 8)
    load_graph(spark, schema, ImportSpec("names", DataSource("table"), (mapping,)), path, options)
    return StoredGraph(spark, path).vertices("Customer")


# Each fault of a row by its number in its order; the second and third lines of an order share a key.
_FAULTY_LINES = (
    "SELECT CAST(CASE l_linenumber WHEN 1 THEN NULL WHEN 3 THEN l_orderkey * 10 + 2 ELSE l_orderkey * 10 + l_linenumber END "
    "AS BIGINT) AS id, l_orderkey * 10 + l_linenumber AS line, "
    "CASE l_linenumber WHEN 4 THEN 'many' ELSE CAST(l_partkey AS {text}) END AS part, "
    "CASE l_linenumber WHEN 5 THEN 70000 WHEN 6 THEN -1 ELSE 1 END AS size FROM lineitem"
)


@_query(
    "SELECT 'Line' AS name, reason, line FROM (SELECT line, CASE WHEN part = 'many' THEN 'lost_cell' WHEN id IS NULL THEN "
    "'null_key' WHEN size NOT BETWEEN 0 AND 65535 THEN 'out_of_range' WHEN count(*) OVER (PARTITION BY id) > 1 THEN "
    f"'repeated_key' END AS reason FROM ({_FAULTY_LINES.format(text='VARCHAR')})) WHERE reason IS NOT NULL "
    f"UNION ALL SELECT '{BUILDING_PLACED}', 'no_source', o_orderkey FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
def rejected_rows(spark, sf_dir):
    spark.sql(_FAULTY_LINES.format(text="STRING")).createOrReplaceTempView("faulty_lines")
    types = {"id": INT64, "line": INT64, "part": INT64, "size": "DT_UNSIGNED_INT16"}
    line = VertexType("Line", tuple(Property(p, t) for p, t in types.items()), ("id",))
    mapping = VertexMapping("Line", ("faulty_lines",), tuple(ColumnMapping(p, p) for p in types))
    schema, spec = table_schema(), table_spec(["BuildingCustomer", "Order"], [BUILDING_PLACED])
    schema = replace(schema, vertex_types=(*schema.vertex_types, line))
    spec = replace(spec, vertices=(*spec.vertices, mapping))
    path = Scratch(spark).path
    load_graph(spark, schema, spec, path, LoadOptions(on_error="reject", vertex_chunk_size=VERTEX_CHUNK))
    graph = StoredGraph(spark, path)

    def rejected(name, key: str) -> DataFrame:
        number = F.get_json_object("raw", f"$.{key}").cast("bigint").alias("line")
        return graph.rejected(name).select(F.lit(str(name)).alias("name"), "reason", number)

    return rejected("Line", "line").unionByName(rejected(BUILDING_PLACED, "dst"))


@_query(_offsets_sql("customer", "c_nationkey", "nation", "n_nationkey"))
def graph_roundtrip_offsets(spark, sf_dir):
    return _loaded(spark, [LIVES_IN]).offsets(LIVES_IN, "destination")


@_query(
    "SELECT 'vertex' AS kind, 'BuildingCustomer' AS name, count(*) AS rows FROM customer "
    "WHERE c_mktsegment = 'BUILDING' "
    "UNION ALL SELECT 'vertex', 'Order', count(*) FROM orders UNION ALL SELECT 'vertex', 'Part', count(*) FROM part "
    f"UNION ALL SELECT 'edge', '{BUILDING_PLACED}', count(*) FROM orders WHERE o_custkey IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') "
    f"UNION ALL SELECT 'edge', '{CONTAINS}', count(*) FROM lineitem"
)
def graph_manifest(spark, sf_dir):
    return _loaded(spark, [BUILDING_PLACED, CONTAINS]).counts()


def out_degrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer by vertex number, customers without orders included."""
    register_tables(spark, sf_dir)
    indexed = _key_index(spark, "Customer")
    degrees = _resolved(spark, PLACED).groupBy(F.col("src_vid").alias("vid")).agg(F.count(F.lit(1)).alias("orders"))
    return (
        indexed.join(degrees, "vid", "left")
        .select("vid", "id", F.coalesce("orders", F.lit(0).cast("bigint")).alias("orders"))
    )


_QUERIES["out_degrees"] = out_degrees
_SQL["out_degrees"] = (
    f"SELECT CAST(vid AS BIGINT) AS vid, id, (SELECT count(*) FROM orders WHERE o_custkey = id) AS orders "
    f"FROM {_ranked_sql('customer', 'c_custkey')}"
)
