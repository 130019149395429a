"""The graph as files: one table per label and arrangement, chunk by chunk.

    <version>/vertices/<label>/vertex_chunk=<n>/
    <version>/edges/<source>/<edge>/<destination>/by_source/vertex_chunk=<n>/range=<m>/
    <version>/edges/<source>/<edge>/<destination>/by_source_starts/
    <version>/edges/<source>/<edge>/<destination>/by_source_offsets/vertex_chunk=<n>/
    (the same with by_destination)
    <version>/rejects/vertices/<label>/ and <version>/rejects/edges/<source>/<edge>/<destination>/

Edges have their range and their place in it; the small table of starts says where each
range begins in its vertex chunk, so positions and edge chunks are known on reading.

Each load writes a version folder of its own, which readers find by its manifest
(``publication``).
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weftgraph.functions.types import quoted
from weftgraph.operators.adjacency import with_positions
from weftgraph.operators.rejects import REJECT_COLUMNS
from weftgraph.sinks.publication import current, version_path
from weftgraph.spec import Triplet

FILE_FORMATS = ("orc", "parquet")
DIRECTIONS = ("source", "destination")

START_COLUMNS = [
    ["vertex_chunk", "bigint"],
    ["range", "int"],
    ["rows", "bigint"],
    ["first_place", "bigint"],
    ["first_pos", "bigint"],
    ["whole", "boolean"],
]
OFFSET_COLUMNS = [["vertex_chunk", "bigint"], ["vid", "bigint"], ["offset", "bigint"]]


def vertex_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/vertices/{quote(label, safe='')}"


def edge_path(root: str, triplet: Triplet, direction: str, part: str = "") -> str:
    if direction not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}, not {direction!r}")
    return f"{root.rstrip('/')}/{_edges(triplet)}/by_{direction}{part}"


def starts_path(root: str, triplet: Triplet, direction: str) -> str:
    return edge_path(root, triplet, direction, "_starts")


def reject_path(root: str, name: str | Triplet) -> str:
    below = _edges(name) if isinstance(name, Triplet) else f"vertices/{quote(name, safe='')}"
    return f"{root.rstrip('/')}/rejects/{below}"


def _edges(triplet: Triplet) -> str:
    return "/".join(["edges", *[quote(n, safe="") for n in (triplet.source, triplet.edge, triplet.destination)]])


def write_chunks(
    frame: DataFrame, path: str, file_format: str, mode: str, by: tuple[str, ...] = ("vertex_chunk",)
) -> None:
    """Write a frame with one folder per chunk, so that no file holds rows of two."""
    if file_format not in FILE_FORMATS:
        raise ValueError(f"graph files are {FILE_FORMATS}, not {file_format!r}")
    (
        frame.write.format(file_format)
        .mode(mode)
        .option("partitionOverwriteMode", "static")
        .partitionBy(*by)
        .save(path)
    )


def write_table(frame: DataFrame, path: str, file_format: str) -> None:
    """Write a frame as it is."""
    frame.write.format(file_format).mode("errorifexists").save(path)


def read_chunks(spark: SparkSession, path: str, file_format: str, columns: list[list[str]]) -> DataFrame:
    """Read what ``write_chunks`` or ``write_table`` wrote, under the column order and types it had."""
    schema = T.StructType([T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in columns])
    return spark.read.format(file_format).schema(schema).load(path).select(*[quoted(name) for name, _ in columns])


def columns_of(frame: DataFrame) -> list[list[str]]:
    return [[f.name, f.dataType.simpleString()] for f in frame.schema]


class StoredGraph:
    """A written graph, read back as frames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        published = current(spark, root)
        self.manifest = published.manifest
        self.root = version_path(root, published.load)

    def vertices(self, label: str) -> DataFrame:
        return self._read(vertex_path(self.root, label), self._label(label)["columns"])

    def edges(
        self, triplet: Triplet, direction: str = "source", vertex_chunk: int | None = None, edge_chunk: int | None = None
    ) -> DataFrame:
        """All edges, those of a vertex chunk, or those of an edge chunk in it; only their files are read."""
        entry = self._edge(triplet, direction)
        written = self._read(edge_path(self.root, triplet, direction), entry["columns"])
        starts = self._read(starts_path(self.root, triplet, direction), START_COLUMNS)
        size = self.manifest["edge_chunk_size"]
        if vertex_chunk is not None:
            written, starts = (frame.where(F.col("vertex_chunk") == vertex_chunk) for frame in (written, starts))
        if edge_chunk is None:
            return with_positions(written, starts, size)
        if vertex_chunk is None:
            raise ValueError("an edge chunk is one of a vertex chunk")
        first = edge_chunk * size
        # A chunk's edges lie in a few ranges that follow each other.
        inside = starts.where((F.col("first_pos") < first + size) & (F.col("first_pos") + F.col("rows") > first))
        ranges = [r["range"] for r in inside.select("range").collect()]
        chosen = written.where(quoted(written.columns[1]).isin(ranges))
        return with_positions(chosen, inside, size).where(F.col("edge_chunk") == edge_chunk)

    def rejected(self, name: str | Triplet) -> DataFrame:
        """The rows of a label or triplet that were left out: the reason, and the row as JSON or as its line."""
        entry = self._find("edges", lambda e: _triplet(e) == name, name) if isinstance(name, Triplet) else self._label(name)
        if not entry["rejects"]:
            return self.spark.createDataFrame([], "reason string, raw string")
        return self._read(reject_path(self.root, name), REJECT_COLUMNS)

    def offsets(self, triplet: Triplet, direction: str = "source") -> DataFrame:
        self._edge(triplet, direction)
        return self._read(edge_path(self.root, triplet, direction, "_offsets"), OFFSET_COLUMNS)

    def counts(self) -> DataFrame:
        """Rows per label and triplet as the manifest has them."""
        rows = [("vertex", v["label"], v["rows"]) for v in self.manifest["vertices"]]
        rows += [("edge", str(_triplet(e)), e["rows"]) for e in self.manifest["edges"]]
        return self.spark.createDataFrame(rows, "kind string, name string, rows bigint")

    def _label(self, label: str) -> dict:
        return self._find("vertices", lambda e: e["label"] == label, label)

    def _edge(self, triplet: Triplet, direction: str) -> dict:
        entry = self._find("edges", lambda e: _triplet(e) == triplet, triplet)
        if direction not in entry["directions"]:
            raise ValueError(f"{triplet} is not stored by {direction}")
        return entry

    def _find(self, kind: str, matches, name: object) -> dict:
        for entry in self.manifest[kind]:
            if matches(entry):
                return entry
        raise ValueError(f"{name} is not in the graph")

    def _read(self, path: str, columns: list[list[str]]) -> DataFrame:
        return read_chunks(self.spark, path, self.manifest["format"], columns)


def _triplet(entry: dict) -> Triplet:
    return Triplet(entry["source"], entry["edge"], entry["destination"])
