"""Benchmark decontamination by winnowed fingerprints.

A window is ``width`` consecutive words of a benchmark item; an item of fewer words
is one window. Each window keeps the least hash of its ``gram``-word grams, which
depends on its words alone, so a document that has the same window keeps the same
fingerprint for it: no shared window can be missed. Documents and items are joined
on fingerprints, and a hit is extended to its whole window by comparing 128-bit
hashes of all its words; hits that overlap make longer spans.

The documents are read once. Before the join a document's windows pass a bit table
of all fingerprints, of a fixed size whatever the benchmark holds; it only spares
rows that cannot join. The join itself is planned by Spark from the sizes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftgraph.llm import grams
from weftgraph.scratch import Scratch

WIDTH = 13
GRAM = 5
# The bit table: 2^24 bits, 2 MB on the driver and in each task, whatever the size of the benchmark.
BITS = 24
_CELL = 1 << 12

_WINDOWS = "array<struct<fp:bigint,hi:bigint,lo:bigint,start:int,size:int>>"
_FIELDS = ["fp", "hi", "lo", "start", "size"]
_FIELD_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def _short_key(size: int, hi: np.ndarray) -> np.ndarray:
    """Fingerprint of a window of ``size`` words that has no room for winnowing."""
    return grams.mixed(hi + np.uint64(size))


def _windows(block: grams.Block, sizes: list[int], width: int, gram: int) -> Iterator[tuple]:
    """(document's place in the block, start in the document, size, fingerprint, hash lanes) as arrays."""
    for size in sizes:
        starts, owner = block.windows(size)
        if not len(starts):
            continue
        hi, lo = block.hashes(size)
        if size == width:
            anchors = block.hashes(gram)[0]
            keys = anchors[grams.winnowed(anchors, starts, width - gram + 1)]
        else:
            keys = _short_key(size, hi[starts])
        yield owner, starts - block.starts[owner], size, keys, hi[starts], lo[starts]


def item_windows(items: DataFrame, id_column: str, text_column: str, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The windows of every item, each once: item_id, fp, hi, lo, size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in grams.blocks(grams.text_bytes(batch.column(1)), grams.alphanumeric_words):
                short = sorted({int(c) for c in block.counts if 0 < c < width})
                for owner, _, size, fp, hi, lo in _windows(block, [*short, width], width, gram):
                    # A short window must be its item's whole text.
                    own = block.counts[owner] == size if size < width else np.ones(len(owner), dtype=bool)
                    at = pa.array(block.rows[owner[own]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(at),
                            *[pa.array(grams.signed(x[own])) for x in (fp, hi, lo)],
                            pa.array(np.full(int(own.sum()), size, dtype=np.int32)),
                        ],
                        names=["item_id", "fp", "hi", "lo", "size"],
                    )

    kind = items.schema[id_column].dataType.simpleString()
    source = items.select(F.col(f"`{id_column}`"), F.col(f"`{text_column}`").cast("string"))
    return source.mapInArrow(run, f"item_id {kind}, fp bigint, hi bigint, lo bigint, size int").distinct()


def _bit_table(windows: DataFrame) -> np.ndarray:
    """Bits of all fingerprints; at most 2^BITS / _CELL rows of _CELL bits come to the driver."""
    bit = F.shiftrightunsigned("fp", 64 - BITS)
    cells = (
        windows.select((bit / F.lit(_CELL)).cast("int").alias("cell"), (bit % F.lit(_CELL)).cast("int").alias("bit"))
        .distinct()
        .groupBy("cell")
        .agg(F.collect_list("bit").alias("bits"))
    )
    table = np.zeros(1 << BITS, dtype=bool)
    for row in cells.toLocalIterator():
        table[row["cell"] * _CELL + np.array(row["bits"])] = True
    return np.packbits(table, bitorder="little")


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    least_share: tuple[int, int] = (1, 20),
) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_hit, n_items, items_sha256, contaminated.

    Words are runs of ASCII letters and digits (A-Z lower-cased) and of all other
    non-ASCII characters. A word inside an occurrence of any item's window is hit; a
    document is contaminated if it has hits in at least ``least_share`` (a fraction of two
    integers) of its words.
    ``items_sha256`` is over the ids of the items with occurring windows, sorted as
    strings and joined by commas; without hits it is the hash of the empty string.

    A null or empty text has no words and no hits, and an item without words has no
    windows; a null item id is left out of the list of ids but its words count as
    hit. Rows that repeat an id are one document each. An empty benchmark hits
    nothing, no documents give no rows, and other columns are ignored.
    """
    windows = scratch.keep(
        item_windows(items, item_id_column, item_text_column, width, gram), "windows"
    )
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(_bit_table(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        for batch in batches:
            ids = batch.column(0)
            for block in grams.blocks(grams.text_bytes(batch.column(1)), grams.alphanumeric_words):
                found = [(np.empty(0, np.int64),) * 6]
                for owner, start, size, fp, hi, lo in _windows(block, sizes, width, gram):
                    at = fp >> np.uint64(64 - BITS)
                    passed = ((table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
                    lanes = [grams.signed(x[passed]) for x in (fp, hi, lo)]
                    found.append((owner[passed], *lanes, start[passed], np.full(passed.sum(), size)))
                owner, *fields = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(owner, kind="stable")
                offsets = np.searchsorted(owner[order], np.arange(len(block.rows) + 1)).astype(np.int32)
                windows_of = pa.StructArray.from_arrays(
                    [pa.array(x[order]).cast(kind) for x, kind in zip(fields, _FIELD_TYPES)], names=_FIELDS
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(block.rows)),
                        pa.array(block.counts),
                        pa.ListArray.from_arrays(pa.array(offsets), windows_of),
                    ],
                    names=["id", "n_words", "windows"],
                )

    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    scanned = source.mapInArrow(run, f"id {kind}, n_words bigint, windows {_WINDOWS}")
    scanned = scratch.keep(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")

    key = ["fp", "hi", "lo", "size"]
    candidates = scanned.select("row", F.inline("windows"))
    hits = candidates.join(windows.select(*key).distinct(), key).select("row", "start", *key)
    hits = scratch.keep(hits, "hits")
    ends = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda so_far, w: F.struct(
            (so_far["n"] + F.greatest(F.lit(0), w["end"] - F.greatest(w["start"], so_far["end"]))).alias("n"),
            F.greatest(so_far["end"], w["end"]).alias("end"),
        ),
        lambda so_far: so_far["n"],
    )
    covered = hits.groupBy("row").agg(ends.cast("bigint").alias("n_hit"))
    of_items = (
        hits.select("row", *key)
        .distinct()
        .join(windows, key)
        .select("row", F.col("item_id").cast("string").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.count("item").alias("n_items"), F.array_sort(F.collect_list("item")).alias("items"))
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        scanned.select("row", "id", "n_words")
        .join(covered, "row", "left")
        .join(of_items, "row", "left")
        .select(
            F.col("id").alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
            F.coalesce(F.sha2(F.concat_ws(",", "items").cast("binary"), 256), none).alias("items_sha256"),
            (
                (F.coalesce("n_hit", F.lit(0)) > 0)
                & (F.coalesce("n_hit", F.lit(0)) * least_share[1] >= F.col("n_words") * least_share[0])
            ).alias("contaminated"),
        )
    )
