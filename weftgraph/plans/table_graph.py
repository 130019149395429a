"""A graph over the given tables: its schema and its import mapping.

Labels    Customer, BuildingCustomer (one segment), Order, Part, Supplier, Nation, Region, Page
Triplets  Customer-Placed->Order, BuildingCustomer-Placed->Order, Order-Contains->Part,
          Part-SoldBy->Supplier, Part-Beside->Part, Customer-LivesIn->Nation, Nation-Within->Region
"""

from __future__ import annotations

from pyspark.sql import SparkSession

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

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

INT64, INT32, TEXT, NAME, DOUBLE = (
    "DT_SIGNED_INT64",
    "DT_SIGNED_INT32",
    "DT_STRING",
    "DT_STRINGMAP",
    "DT_DOUBLE",
)

# label: (table, key column, [(source column, property, type)]), the key first.
VERTICES = {
    "Customer": (
        "customer",
        [
            ("c_custkey", "id", INT64),
            ("c_name", "name", TEXT),
            ("c_nationkey", "nation", INT32),
            ("c_acctbal", "balance", DOUBLE),
            ("c_mktsegment", "segment", NAME),
        ],
    ),
    "BuildingCustomer": ("customer", [("c_custkey", "id", INT64), ("c_name", "name", TEXT)]),
    "Order": (
        "orders",
        [
            ("o_orderkey", "id", INT64),
            ("o_orderstatus", "status", NAME),
            ("o_totalprice", "price", DOUBLE),
            ("o_orderdate", "placed", INT64),
            ("o_orderpriority", "priority", NAME),
        ],
    ),
    "Part": (
        "part",
        [
            ("p_partkey", "id", INT64),
            ("p_name", "name", TEXT),
            ("p_brand", "brand", NAME),
            ("p_size", "size", "DT_UNSIGNED_INT8"),
            ("p_retailprice", "price", DOUBLE),
        ],
    ),
    "Supplier": ("supplier", [("s_suppkey", "id", INT64), ("s_name", "name", TEXT), ("s_acctbal", "balance", DOUBLE)]),
    "Nation": ("nation", [("n_nationkey", "id", INT32), ("n_name", "name", TEXT)]),
    "Region": ("region", [("r_regionkey", "id", INT32), ("r_name", "name", TEXT)]),
    "Page": ("pages", [("url", "url", TEXT), ("page_id", "page", INT64)]),
}

LINE = [
    ("l_linenumber", "line", "DT_UNSIGNED_INT16"),
    ("l_quantity", "quantity", DOUBLE),
    ("l_extendedprice", "price", DOUBLE),
    ("l_shipdate", "shipped", INT64),
]

# triplet: (table, source column, destination column, [(source column, property, type)])
EDGES = {
    Triplet("Customer", "Placed", "Order"): (
        "orders",
        "o_custkey",
        "o_orderkey",
        [("o_totalprice", "price", DOUBLE), ("o_orderdate", "placed", INT64)],
    ),
    Triplet("BuildingCustomer", "Placed", "Order"): (
        "orders",
        "o_custkey",
        "o_orderkey",
        [("o_totalprice", "price", DOUBLE), ("o_orderdate", "placed", INT64)],
    ),
    Triplet("Order", "Contains", "Part"): ("lineitem", "l_orderkey", "l_partkey", LINE),
    Triplet("Part", "SoldBy", "Supplier"): (
        "lineitem",
        "l_partkey",
        "l_suppkey",
        [("l_quantity", "quantity", DOUBLE), ("l_discount", "discount", DOUBLE)],
    ),
    Triplet("Part", "Beside", "Part"): ("lineitem", "l_partkey", "l_suppkey", [("l_returnflag", "flag", NAME)]),
    Triplet("Customer", "LivesIn", "Nation"): ("customer", "c_custkey", "c_nationkey", []),
    Triplet("Nation", "Within", "Region"): ("nation", "n_nationkey", "n_regionkey", []),
}

# The label that is one partition of its table.
PARTITIONS = {"BuildingCustomer": "c_mktsegment=BUILDING"}


def table_schema() -> GraphSchema:
    edge_types: dict[str, list] = {}
    for triplet, (_, _, _, columns) in EDGES.items():
        edge_types.setdefault(triplet.edge, []).append((EdgePair(triplet.source, triplet.destination), columns))
    return GraphSchema(
        name="tables",
        vertex_types=tuple(
            VertexType(label, tuple(Property(p, t) for _, p, t in columns), (columns[0][1],))
            for label, (_, columns) in VERTICES.items()
        ),
        edge_types=tuple(
            EdgeType(name, tuple(pair for pair, _ in uses), tuple(Property(p, t) for _, p, t in uses[0][1]))
            for name, uses in edge_types.items()
        ),
    )


def table_spec(labels: list[str], triplets: list[Triplet] = ()) -> ImportSpec:
    """The mapping of the named labels and triplets, read as catalog tables."""
    return ImportSpec(
        graph="tables",
        source=DataSource(scheme="table"),
        vertices=tuple(
            VertexMapping(label, (_vertex_input(label),), _columns(VERTICES[label][1])) for label in labels
        ),
        edges=tuple(_edge_mapping(t) for t in triplets),
    )


def register_tables(spark: SparkSession, sf_dir: str) -> None:
    """Make the given Parquet files known as views of the session."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def _vertex_input(label: str) -> str:
    table = VERTICES[label][0]
    return f"{table}/{PARTITIONS[label]}" if label in PARTITIONS else table


def _edge_mapping(triplet: Triplet) -> EdgeMapping:
    table, source, destination, columns = EDGES[triplet]
    return EdgeMapping(
        triplet, (table,), (ColumnMapping(source),), (ColumnMapping(destination),), _columns(columns)
    )


def _columns(columns: list) -> tuple[ColumnMapping, ...]:
    return tuple(ColumnMapping(column, prop) for column, prop, _ in columns)
