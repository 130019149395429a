"""Refusing to write a graph over the inputs it is made from."""

from __future__ import annotations

import os
import posixpath
import re
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from weftgraph.sinks import publication
from weftgraph.sources.files import input_path
from weftgraph.sources.tables import table_and_partitions
from weftgraph.spec import ImportSpec, SpecError


def refuse_own_inputs(spark: SparkSession, spec: ImportSpec, path: str) -> None:
    """Raise if an input lies in the folder the graph is written to, or the folder in an input.

    Inputs are compared by their roots, with links resolved and ports left out. Names
    cannot tell everything (one store may be mounted twice), so before an existing
    version is replaced the store itself is asked whether that version holds a file of
    an input.
    """
    names = list(dict.fromkeys(i for mapping in (*spec.vertices, *spec.edges) for i in mapping.inputs))
    roots = list(dict.fromkeys(root for name in names for root in input_roots(spark, spec, name)))
    for root in roots:
        if overlap(root, path):
            raise SpecError(f"input {root!r} lies in the folder the graph is written to")
    replaced = [e for e in publication.entries(spark, path) if e.state == publication.COMPLETE]
    for entry in replaced:
        version = publication.version_path(path, entry.load)
        for root in roots:
            name = a_file_below(spark, root)
            # Spark gives each file it writes a name of its own.
            if name and a_file_below(spark, version, name):
                raise SpecError(f"input {root!r} lies in the folder the graph is written to: {version!r} holds {name!r}")


def input_roots(spark: SparkSession, spec: ImportSpec, name: str) -> Iterator[str]:
    """Where an input's files are: its path, its table's location, or the files a view or a partitioned table reads."""
    full = input_path(spec.source.location, name)
    if spec.source.kind != "table":
        yield full
        return
    table, _ = table_and_partitions(full)
    try:
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(table)}").collect()}
    except AnalysisException:
        described = {}
    # Partitions may have places of their own, which only their files tell.
    if described.get("Location") and "# Partition Information" not in described and described.get("Type") != "VIEW":
        yield described["Location"]
    else:
        yield from dict.fromkeys(posixpath.dirname(f) for f in spark.table(table).inputFiles())


def quoted_name(table: str) -> str:
    return table if "`" in table else ".".join(f"`{part}`" for part in table.split("."))


def a_file_below(spark: SparkSession, root: str, name: str = "*") -> str | None:
    """The name of some file below a folder, if there is one of that name."""
    pattern = name if name == "*" else re.sub(r"[][{}*?\\\\]", "?", name)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    try:
        found = files.load(root).select("path").first()
    except AnalysisException:
        return None
    return posixpath.basename(found["path"]) if found else None


def overlap(one: str, other: str) -> bool:
    """Whether one path lies in the other, as far as names tell. A path without a scheme may be of any store."""
    (store, path), (other_store, other_path) = _place(one), _place(other)
    inside = path.startswith(other_path) or other_path.startswith(path)
    return inside and (store == other_store or not store or not other_store)


def _place(path: str) -> tuple[str, str]:
    """Scheme and host, and the path without dots and links, closed by a slash."""
    parts = urlsplit(path)
    plain = unquote(parts.path)
    if parts.scheme in ("", "file"):
        plain = os.path.realpath(plain)
    store = f"{parts.scheme}://{(parts.hostname or '').lower()}" if parts.scheme else ""
    return store, posixpath.normpath(plain).rstrip("/") + "/"
