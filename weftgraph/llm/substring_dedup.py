"""Removing word passages that a document with a smaller id has as well.

Seeds are winnowed anchors: every window of ``WIDTH`` words keeps the least hash of
its ``GRAM``-word grams, so equal windows keep the same anchor at the same place.
The windows that keep one anchor lie side by side; together they are its reach, the
anchor extended both ways as far as a shared window can go.

Documents are joined on anchors through each anchor's least document, never in
pairs. Where all occurrences of an anchor have the same reach, the extension is
settled at once: the whole reach repeats in every document after the first. Only
where reaches differ (at the ends of repeats, and at grams that happen to agree) are
the windows compared one by one, by 128-bit hashes of their words and again through
the least document of each. Windows found to repeat are merged into maximal spans.
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


def anchors_of(block: grams.Block, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: its document's place in the block, first and last window that keep it, its hash, its reach's hash."""
    starts, owner = block.windows(width)
    if not len(starts):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = block.hashes(gram)[0]
    chosen = grams.winnowed(hashes, starts, width - gram + 1)
    firsts = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
    lasts = np.append(firsts[1:], len(starts)) - 1
    whole = block.hashes(width)[0]
    # The first and the last window overlap or touch, so both and their distance fix all words between.
    reach = whole[starts[firsts]] * np.uint64(0x9E3779B97F4A7C15) + whole[starts[lasts]]
    reach = grams.mixed(reach + (lasts - firsts).astype(np.uint64))
    own = owner[firsts]
    shift = block.starts[own]
    return own, starts[firsts] - shift, starts[lasts] - shift, hashes[chosen[firsts]], reach


def _anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in grams.blocks(grams.text_bytes(batch.column(1)), grams.plain_words):
                own, first, last, anchor, reach = anchors_of(block, width, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.signed(anchor)),
                        batch.column(0).take(pa.array(block.rows[own])),
                        # The first window and, in the lowest bits, how many more; one number shuffles in less room.
                        pa.array(first * width + (last - first)),
                        pa.array(grams.signed(reach)),
                    ],
                    names=["anchor", "id", "windows", "reach"],
                )

    return docs.mapInArrow(run, "anchor bigint, id bigint, windows bigint, reach bigint")


_RESULT = "id bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept string"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_PENDING = f"{_RESULT}, pack binary, hi array<bigint>, lo array<bigint>, at array<int>"


def spans_of(covered: np.ndarray) -> list[dict]:
    """Maximal runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def _finished(words: list[bytes], covered: np.ndarray, as_digest: bool) -> tuple[int, int, list[dict], str]:
    kept = b" ".join([w for w, c in zip(words, covered) if not c]) if covered.any() else b" ".join(words)
    shown = hashlib.sha256(kept).hexdigest() if as_digest else kept.decode()
    return len(words), int(covered.sum()), spans_of(covered), shown


def _covered(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` words lie in a range; what lies beyond the words is ignored."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, np.minimum(starts, size), 1)
    np.add.at(steps, np.minimum(ends, size), -1)
    return np.cumsum(steps)[:size] > 0


def _result(rows: list[tuple]) -> list[pa.Array]:
    ids, sizes, removed, spans, kept = zip(*rows) if rows else ((),) * 5
    return [
        pa.array(ids, type=pa.int64()),
        pa.array(sizes, type=pa.int64()),
        pa.array(removed, type=pa.int64()),
        pa.array(spans, type=_SPANS),
        pa.array(kept, type=pa.string()),
    ]


_NAMES = ["id", "n_words", "n_removed", "spans", "kept"]


def _settled(docs: DataFrame, width: int, as_digest: bool) -> DataFrame:
    """Finished rows, and rows whose ``pack`` is kept because some of their windows are still to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, packs = grams.unpacked(batch.column(1)), batch.column(1).to_pylist()
            rows, pack, hi, lo, at = [], [], [], [], []
            for i, ranges in enumerate(batch.column(2).to_pylist()):
                words = grams.plain_words(texts[i])
                ranges = ranges or []
                even = np.array([(r["first"], r["last"]) for r in ranges if r["even"]], dtype=np.int64).reshape(-1, 2)
                covered = _covered(len(words), even[:, 0], even[:, 1] + width)
                starts = [np.arange(r["first"], r["last"] + 1) for r in ranges if not r["even"]]
                starts = np.unique(np.concatenate(starts)) if starts else np.empty(0, dtype=np.int64)
                starts = starts[starts <= len(words) - width]
                number = batch.column(0)[i].as_py()
                if len(starts):
                    lanes = [grams.rolled(x, width, b) for x, b in zip(grams.word_lanes(words), grams.BASES)]
                    rows.append((number, len(words), 0, spans_of(covered), None))
                    pack.append(packs[i])
                    hi.append(grams.signed(lanes[0][starts]))
                    lo.append(grams.signed(lanes[1][starts]))
                    at.append(starts.astype(np.int32))
                else:
                    rows.append((number, *_finished(words, covered, as_digest)))
                    for column in (pack, hi, lo, at):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    *_result(rows),
                    pa.array(pack, type=pa.binary()),
                    pa.array(hi, type=pa.list_(pa.int64())),
                    pa.array(lo, type=pa.list_(pa.int64())),
                    pa.array(at, type=pa.list_(pa.int32())),
                ],
                names=[*_NAMES, "pack", "hi", "lo", "at"],
            )

    return docs.mapInArrow(run, _PENDING)


def _completed(pending: DataFrame, width: int, as_digest: bool) -> DataFrame:
    """Rows (id, pack, spans, starts of repeated windows) finished."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            ids, *lists = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for number, text, spans, starts in zip(ids, grams.unpacked(batch.column(1)), *lists):
                words = grams.plain_words(text)
                found = np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64).reshape(-1, 2)
                more = np.array(starts or [], dtype=np.int64)
                covered = _covered(
                    len(words), np.append(found[:, 0], more), np.append(found[:, 1], more + width)
                )
                rows.append((number, *_finished(words, covered, as_digest)))
            yield pa.RecordBatch.from_arrays(_result(rows), names=_NAMES)

    return pending.mapInArrow(run, _RESULT)


def substring_dedup(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    as_digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_words, n_removed, spans (word ranges removed), kept.

    Words are runs of anything but ASCII white space. A word goes if it lies in a
    window of ``width`` words that also starts in a document with a smaller id;
    windows are judged on the input. ``kept`` is the remaining words joined by single
    spaces, or with ``as_digest`` their SHA-256 in hexadecimal, which spares keeping
    the texts.

    A null text has no words. A row with a null id is compared with nothing: all its
    words stay, and it removes none. Rows that repeat an id are one document: none
    removes words of another, and what is found at a place of one is removed at the
    same place of all. No rows give no rows; other columns are ignored. Ids must be
    integers.
    """
    source = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    anchors = _anchors(source.where("id IS NOT NULL"), width, gram)
    folder = scratch.folder("settled")
    with Scratch(docs.sparkSession) as passing:
        shared = anchors.groupBy("anchor").agg(
            F.min("id").alias("least"),
            F.max("id").alias("most"),
            F.min("reach").alias("low"),
            F.max("reach").alias("high"),
        )
        shared = shared.where("least < most").select("anchor", "least", (F.col("low") == F.col("high")).alias("even"))
        shared = passing.keep(shared, "shared")
        ranges = anchors.select("anchor", "id", "windows").join(shared, "anchor").where("NOT even OR id > least")
        first = F.expr(f"windows div {int(width)}")
        ranges = ranges.select(
            "id", "even", first.cast("int").alias("first"), (first + F.col("windows") % width).cast("int").alias("last")
        )
        # At most one range for each anchor of a text, and as a set once for all rows that repeat an id and text.
        of_document = ranges.groupBy("id").agg(F.collect_set(F.struct("first", "last", "even")).alias("ranges"))
        texts = grams.packed(source).join(of_document, "id", "left").select("id", "pack", "ranges")
        settled = _settled(texts, width, as_digest)
        settled.write.option("compression", "zstd").parquet(folder)
    settled = docs.sparkSession.read.schema(_PENDING).parquet(folder)

    pending = settled.where("pack IS NOT NULL")
    windows = pending.select("id", F.inline(F.arrays_zip("hi", "lo", "at")))
    repeated = windows.groupBy("hi", "lo").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    repeated = windows.join(repeated.where("least < most").drop("most"), ["hi", "lo"]).where("id > least")
    # Rows that repeat an id have the same starts, so these are a set.
    starts = repeated.groupBy("id").agg(F.collect_set("at").alias("starts"))
    last = pending.select("id", "pack", "spans").join(starts, "id", "left").select("id", "pack", "spans", "starts")
    finished = settled.where("pack IS NULL").select(*_NAMES).unionByName(_completed(last, width, as_digest))
    return finished.withColumnRenamed("id", id_column)
