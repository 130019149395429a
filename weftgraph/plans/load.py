"""Loading a graph: vertices, then edges, then the manifest."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.functions.types import quoted
from weftgraph.operators.adjacency import arranged, offsets, range_starts
from weftgraph.operators.endpoints import heavy_keys, matched_edges
from weftgraph.operators.index import chunk_of, vertex_index
from weftgraph.operators.mapping import EdgeFrame, VertexFrame, edge_frame, vertex_frame
from weftgraph.operators.rejects import END_REASONS, Sorted, split_edges, split_vertices
from weftgraph.scratch import Scratch, delete_folder
from weftgraph.plans.own_inputs import refuse_own_inputs
from weftgraph.sinks import publication
from weftgraph.sinks.graph_files import (
    FILE_FORMATS,
    OFFSET_COLUMNS,
    START_COLUMNS,
    columns_of,
    edge_path,
    read_chunks,
    reject_path,
    starts_path,
    vertex_path,
    write_chunks,
    write_table,
)
from weftgraph.spec import GraphSchema, ImportSpec, Triplet, validate

VERTEX_CHUNK_SIZE = 1 << 18
EDGE_CHUNK_SIZE = 1 << 22
# Labels of fewer vertices are joined without looking for hubs: their index is small wherever it has to go.
FEW_VERTICES = 1 << 17


class DanglingEdgesError(ValueError):
    """Edges point to vertices that do not exist, and the load was told not to drop them."""


class UnstableSourceError(RuntimeError):
    """A source gave different rows in two passes of the same load."""


@dataclass(frozen=True)
class LoadOptions:
    file_format: str = "orc"
    vertex_chunk_size: int = VERTEX_CHUNK_SIZE
    edge_chunk_size: int = EDGE_CHUNK_SIZE
    column_naming: str = "property"
    on_error: str | None = None
    dangling: str = "drop"
    rows_per_range: int | None = None
    tables_at_once: int = 4

    def check(self) -> None:
        for name, allowed in (
            ("file_format", FILE_FORMATS),
            ("on_error", (None, "raise", "null", "reject")),
            ("dangling", ("drop", "error")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} is one of {allowed}, not {getattr(self, name)!r}")
        if min(self.vertex_chunk_size, self.edge_chunk_size, self.tables_at_once) < 1:
            raise ValueError("chunk sizes and tables_at_once must be positive")


@dataclass(frozen=True)
class VertexReport:
    label: str
    key: str
    rows: int
    columns: list
    rejects: dict = field(default_factory=dict)


@dataclass(frozen=True)
class EdgeReport:
    source: str
    edge: str
    destination: str
    rows: int
    dangling: int
    directions: list
    columns: list
    rejects: dict = field(default_factory=dict)


@dataclass(frozen=True)
class LoadReport:
    path: str
    vertices: list[VertexReport] = field(default_factory=list)
    edges: list[EdgeReport] = field(default_factory=list)


def load_vertices(
    spark: SparkSession, schema: GraphSchema, spec: ImportSpec, naming: str = "property", on_error: str | None = None
) -> dict[str, VertexFrame]:
    """The frame of every mapped label, not yet run."""
    return {m.label: vertex_frame(spark, schema, spec, m.label, naming, on_error) for m in spec.vertices}


def load_edges(
    spark: SparkSession, schema: GraphSchema, spec: ImportSpec, naming: str = "property", on_error: str | None = None
) -> dict[Triplet, EdgeFrame]:
    """The frame of every mapped triplet, not yet run."""
    return {m.triplet: edge_frame(spark, schema, spec, m.triplet, naming, on_error) for m in spec.edges}


def load_graph(
    spark: SparkSession, schema: GraphSchema, spec: ImportSpec, path: str, options: LoadOptions | None = None
) -> LoadReport:
    """Load every mapped label and triplet and write the graph below ``path``.

    Raises on any failure. A first load then leaves nothing that can be read as a graph;
    a load that replaces a graph leaves the old one, even if it ends without a word.
    """
    options = options or LoadOptions()
    options.check()
    validate(schema, spec, options.column_naming)
    frames = (spark, schema, spec, options.column_naming, options.on_error)
    vertices, edges = load_vertices(*frames), load_edges(*frames)
    refuse_own_inputs(spark, spec, path)
    claimed = publication.claim(spark, path, first=spec.save_mode != "overwrite")
    files = publication.version_path(path, claimed.load)
    scratch = Scratch(spark)
    try:
        if spec.source.options.get("mode") == "DROPMALFORMED":
            # Which rows that drops depends on the columns a pass reads, so they are all read once.
            vertices = {n: replace(v, frame=scratch.keep(v.frame, "source")) for n, v in vertices.items()}
            edges = {n: replace(e, frame=scratch.keep(e.frame, "source")) for n, e in edges.items()}

        def store_label(vertex: VertexFrame) -> VertexReport:
            return _store_vertices(vertex, files, options, scratch)

        stored = dict(zip(vertices, _together(spark, store_label, vertices.values(), options)))
        indexes = {label: _index(spark, files, report, options) for label, report in stored.items()}
        sizes = {label: report.rows for label, report in stored.items()}

        def store_triplet(edge: EdgeFrame) -> EdgeReport:
            out_only = schema.pair(edge.triplet).out_only
            return _store_edges(edge, indexes, sizes, out_only, files, options, scratch)

        edge_reports = _together(spark, store_triplet, edges.values(), options)
        report = LoadReport(path, list(stored.values()), edge_reports)
        manifest = {
            "name": schema.name,
            "format": options.file_format,
            "vertex_chunk_size": options.vertex_chunk_size,
            "edge_chunk_size": options.edge_chunk_size,
            "vertices": [asdict(v) for v in report.vertices],
            "edges": [asdict(e) for e in report.edges],
        }
        publication.publish(spark, path, claimed, manifest)
    except BaseException:
        # The claim first, so that no manifest ever names files that are gone.
        publication.withdraw(spark, path, claimed)
        delete_folder(spark, files)
        raise
    finally:
        scratch.discard()
    publication.drop_replaced(spark, path)
    return report


def _store_vertices(vertex: VertexFrame, path: str, options: LoadOptions, scratch: Scratch) -> VertexReport:
    frame, rejects = vertex.frame, {}
    if vertex.rejected:
        sorted_rows = split_vertices(frame, vertex.rejected, vertex.key, scratch)
        frame, rejects = sorted_rows.kept, sorted_rows.counts
        _store_rejects(sorted_rows, reject_path(path, vertex.label), options)
    indexed, total = vertex_index(frame, vertex.key, scratch, options.rows_per_range)
    chunked = indexed.select(chunk_of("vid", options.vertex_chunk_size), "vid", *[quoted(c) for c in frame.columns])
    target = vertex_path(path, vertex.label)
    write_chunks(chunked.sortWithinPartitions("vertex_chunk", "vid"), target, options.file_format, "errorifexists")
    columns = columns_of(chunked)
    written = read_chunks(frame.sparkSession, target, options.file_format, columns)
    # As many rows as keys, all below their number, with the sum of 0, 1, 2, ...
    count, top, added = written.agg(F.count(F.lit(1)), F.max("vid"), F.sum(F.col("vid").cast("decimal(38)"))).first()
    if count != total or (total and (top != total - 1 or added != total * (total - 1) // 2)):
        raise UnstableSourceError(f"label {vertex.label!r}: {total} keys but {count} rows up to number {top}")
    return VertexReport(vertex.label, vertex.key, total, columns, rejects)


def _store_rejects(rows: Sorted, target: str, options: LoadOptions) -> None:
    if rows.counts:
        write_table(rows.rejects, target, options.file_format)


def _index(spark: SparkSession, path: str, report: VertexReport, options: LoadOptions) -> DataFrame:
    """(key, vid) of a stored label; only these two columns are read."""
    stored = read_chunks(spark, vertex_path(path, report.label), options.file_format, report.columns)
    return stored.select(quoted(report.key), "vid")


def _store_edges(
    edge: EdgeFrame,
    indexes: dict[str, DataFrame],
    sizes: dict[str, int],
    out_only: bool,
    path: str,
    options: LoadOptions,
    scratch: Scratch,
) -> EdgeReport:
    triplet, spark = edge.triplet, edge.frame.sparkSession
    labels = {edge.src: triplet.source, edge.dst: triplet.destination}
    heavy = heavy_keys(edge.frame, [end for end, label in labels.items() if sizes[label] >= FEW_VERTICES])
    matched = matched_edges(edge.frame, edge.src, edge.dst, indexes[triplet.source], indexes[triplet.destination], heavy)
    rows = split_edges(matched, (edge.src, edge.dst), edge.rejected, scratch)
    kept, total = rows.kept, rows.rows
    dangling = sum(rows.counts.get(reason, 0) for reason in END_REASONS)
    if dangling and options.dangling == "error":
        raise DanglingEdgesError(f"{triplet}: {dangling} edges have an end without a vertex")
    directions = ["source"] if out_only else ["source", "destination"]

    def store_adjacency(direction: str) -> list:
        in_order = arranged(kept, direction, options.vertex_chunk_size, total, options.rows_per_range)
        target, columns = edge_path(path, triplet, direction), columns_of(in_order)
        write_chunks(in_order, target, options.file_format, "errorifexists", ("vertex_chunk", columns[1][0]))
        starts = range_starts(read_chunks(spark, target, options.file_format, columns))
        write_table(starts, starts_path(path, triplet, direction), options.file_format)
        return columns

    def store_offsets(direction: str) -> list:
        label = triplet.source if direction == "source" else triplet.destination
        starts = offsets(kept, direction, sizes[label], options.vertex_chunk_size)
        write_chunks(starts, edge_path(path, triplet, direction, "_offsets"), options.file_format, "errorifexists")
        return columns_of(starts)

    parts = [(store, direction) for store in (store_adjacency, store_offsets) for direction in directions]
    parts.append((lambda target: _store_rejects(rows, target, options), reject_path(path, triplet)))
    columns = _together(spark, lambda part: part[0](part[1]), parts, options)[0]
    for direction in directions:
        verify_edges(spark, path, triplet, direction, options.file_format, total)
    return EdgeReport(triplet.source, triplet.edge, triplet.destination, total, dangling, directions, columns, rows.counts)


def verify_edges(
    spark: SparkSession,
    path: str,
    triplet: Triplet,
    direction: str,
    file_format: str,
    total: int,
    columns: list | None = None,
) -> None:
    """Raise unless the written edges and offsets both account for ``total`` edges, each place in a chunk once.

    What the edges' files hold is taken from the table of range starts, which was counted
    from them; given their ``columns``, the files are counted again and compared with it.
    """
    starts = read_chunks(spark, starts_path(path, triplet, direction), file_format, START_COLUMNS)
    if columns:
        again = range_starts(read_chunks(spark, edge_path(path, triplet, direction), file_format, columns))
        if not (starts.exceptAll(again).isEmpty() and again.exceptAll(starts).isEmpty()):
            raise UnstableSourceError(f"{triplet} by {direction}: the files do not hold the ranges that were written")
    offset_path = edge_path(path, triplet, direction, "_offsets")
    closing = read_chunks(spark, offset_path, file_format, OFFSET_COLUMNS)
    none = F.lit(None).cast("bigint")
    both = starts.select("vertex_chunk", "rows", "whole", none.alias("end")).unionByName(
        closing.select("vertex_chunk", none.alias("rows"), F.lit(True).alias("whole"), F.col("offset").alias("end"))
    )
    by_chunk = both.groupBy("vertex_chunk").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.max("end").alias("end"), F.bool_and("whole").alias("whole")
    )
    is_damaged = ~(F.col("whole") & (F.col("n") == F.coalesce("end", F.lit(-1))))
    rows, damaged = by_chunk.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(is_damaged)).first()
    if rows != total or damaged:
        raise UnstableSourceError(f"{triplet} by {direction}: {rows} edges written of {total}, {damaged} chunks damaged")


def _together(spark: SparkSession, work: Callable, tables: Iterable, options: LoadOptions) -> list:
    """Run the jobs of several tables side by side, so that small ones do not leave the cluster idle."""
    with ThreadPoolExecutor(options.tables_at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), tables))
