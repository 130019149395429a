"""Publishing the versions of a graph, so that readers always find one whole version.

    manifests/number=<n>/load=<id>/state=claimed/     a load has taken this number
    manifests/number=<n>/load=<id>/state=complete/    the manifest of what it wrote
    version-<id>/                                     the files of that load

No file is ever replaced: each load writes under an id of its own, and readers take the
complete manifest of the highest number. A load

1. claims the next number, and looks again: if another load stands on it, it withdraws
   and takes a later one. Two loads that each claim before they look cannot both believe
   that they are alone, so a number is published once at most;
2. writes its files, which no reader knows of;
3. writes its manifest, the one step that readers see;
4. drops what complete manifests of lower numbers name, files first, so that a crash in
   between leaves a manifest that the next load finds and finishes with.

Loads at the same time end as if they had run one after the other, in the order of their
numbers. What a crashed load leaves is never read; ``sweep`` deletes it.
"""

from __future__ import annotations

import json
import random
import re
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F

from weftgraph.scratch import delete_folder

CLAIMED, COMPLETE = "claimed", "complete"
_PLACE = re.compile(r"/number=(\d+)/load=(\w+)/state=(\w+)/[^/]*$")
ATTEMPTS = 20


class GraphExistsError(RuntimeError):
    """A first load found a graph, or another load, in its folder."""


class IncompleteGraphError(RuntimeError):
    """The folder holds no completely written graph."""


@dataclass(frozen=True)
class Entry:
    number: int
    load: str
    state: str
    manifest: dict

    def folder(self, root: str) -> str:
        return f"{_manifests(root)}/number={self.number}/load={self.load}"


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def version_path(root: str, load: str) -> str:
    """The folder of a load's files."""
    return f"{root.rstrip('/')}/version-{load}"


def entries(spark: SparkSession, root: str) -> list[Entry]:
    """All claims and manifests of a graph's folder; one whose text is not whole counts as a claim."""
    try:
        texts = spark.read.option("recursiveFileLookup", True).text(_manifests(root))
        rows = texts.select("value", F.col("_metadata.file_path").alias("file")).collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found = []
    for row in rows:
        number, load, state = _PLACE.search(row["file"]).groups()
        try:
            manifest = json.loads(row["value"])
        except ValueError:
            manifest, state = {}, CLAIMED
        found.append(Entry(int(number), load, state, manifest))
    return found


def current(spark: SparkSession, root: str) -> Entry:
    """The published version: the complete manifest of the highest number."""
    complete = [e for e in entries(spark, root) if e.state == COMPLETE]
    if not complete:
        raise IncompleteGraphError(f"{root} holds no completely written graph")
    return max(complete, key=lambda e: (e.number, e.load))


def claim(spark: SparkSession, root: str, first: bool) -> Entry:
    """Take the next number for a load; with ``first``, only where there is no graph and no other load."""
    load = uuid.uuid4().hex
    for attempt in range(ATTEMPTS):
        known = entries(spark, root)
        if first and known:
            raise GraphExistsError(f"{root} holds a graph or a load that has not ended")
        own = Entry(1 + max((e.number for e in known), default=0), load, CLAIMED, {})
        _write(spark, root, own)
        others = [e for e in entries(spark, root) if e.load != load]
        if first and others:
            withdraw(spark, root, own)
            raise GraphExistsError(f"another load began in {root}")
        if all(e.number != own.number for e in others):
            return own
        withdraw(spark, root, own)
        time.sleep(random.uniform(0, 0.2 * (attempt + 1)))
    raise GraphExistsError(f"other loads took each number tried in {root}")


def publish(spark: SparkSession, root: str, claimed: Entry, manifest: dict) -> Entry:
    """Make a load's version the one that readers find, unless one of a higher number is there."""
    entry = Entry(claimed.number, claimed.load, COMPLETE, manifest)
    _write(spark, root, entry)
    return entry


def withdraw(spark: SparkSession, root: str, entry: Entry) -> None:
    """Delete a load's claim and manifest; its files are no longer found by then."""
    delete_folder(spark, entry.folder(root))


def drop_replaced(spark: SparkSession, root: str) -> None:
    """Delete complete versions below the published one. Loads that only have a claim may be running."""
    newest = current(spark, root)
    for entry in entries(spark, root):
        if entry.state == COMPLETE and (entry.number, entry.load) < (newest.number, newest.load):
            _drop(spark, root, entry)


def sweep(spark: SparkSession, root: str) -> int:
    """Delete what crashed loads left, and give their number. To be run while no load is running."""
    found = entries(spark, root)
    complete = {e.load for e in found if e.state == COMPLETE}
    crashed = [e for e in found if e.load not in complete]
    for entry in crashed:
        _drop(spark, root, entry)
    if complete:
        drop_replaced(spark, root)
    return len(crashed)


def _drop(spark: SparkSession, root: str, entry: Entry) -> None:
    delete_folder(spark, version_path(root, entry.load))
    withdraw(spark, root, entry)


def _write(spark: SparkSession, root: str, entry: Entry) -> None:
    row = spark.range(1, numPartitions=1).select(F.lit(json.dumps(entry.manifest)).alias("value"))
    row.write.mode("errorifexists").text(f"{entry.folder(root)}/state={entry.state}")
