"""Property graphs from tables, on Spark."""

from weftgraph.plans.check import check_sources
from weftgraph.plans.load import LoadOptions, LoadReport, load_edges, load_graph, load_vertices
from weftgraph.sinks.graph_files import StoredGraph
from weftgraph.spec import GraphSchema, ImportSpec, SpecError, Triplet

__all__ = [
    "GraphSchema",
    "ImportSpec",
    "LoadOptions",
    "LoadReport",
    "SpecError",
    "StoredGraph",
    "Triplet",
    "check_sources",
    "load_edges",
    "load_graph",
    "load_vertices",
]
