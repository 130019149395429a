"""Removing byte strings that occur anywhere else in the corpus, by suffix arrays of shards.

Suffixes are dealt to shards by what they begin with, so that those with ``WIDTH``
equal bytes meet: every string of ``WIDTH`` bytes keeps the least hash of its
``GRAM``-byte grams, its anchor, and goes where the anchor goes. The strings that
keep one anchor start side by side; their bytes together are a piece.

An anchor that occurs once has nothing to compare. Where all of an anchor's pieces are
equal, all their strings repeat. The other pieces, each distinct one once, form the
shards' texts. A shard's suffix array is made by induced sorting, and a string repeats
if its permuted longest common prefix with a neighbour in the array has ``WIDTH``
bytes. An anchor with very many different pieces is split over several shards; what is
single in its shard is then looked up among one string of each kind of the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from weftgraph.llm import grams
from weftgraph.llm.substring_dedup import spans_of
from weftgraph.llm.suffix_array import permuted_common_prefixes, suffix_array
from weftgraph.scratch import Scratch

WIDTH = 400
GRAM = 48
# Bytes of text hashed at once; longer texts are cut, with an overlap.
SLICE = 1 << 19
# Bytes of a shard's text, and occurrences of an anchor from which its pieces are split.
SHARD_BYTES = 1 << 18
SPLIT = 2048
_PLACE_BITS = np.uint64(31)
_PLACE = np.uint64((1 << 31) - 1)
_BASE = 0x9E3779B97F4A7C15
_OF_BYTE = grams.mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
_NO_ID = -(1 << 63)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse, made once in a task."""

    def __init__(self):
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


def gram_hashes(data: np.ndarray, gram: int, powers: _Powers) -> np.ndarray:
    up, down = powers.of(len(data))
    sums = np.cumsum(_OF_BYTE[data] * up, dtype=np.uint64)
    own = sums[gram - 1 :].copy()
    own[1:] -= sums[: len(sums) - gram]
    return grams.mixed(own * down[: len(own)])


def least_in_windows(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive values, by running minima of blocks from both sides."""
    n = len(values)
    padded = np.full(-(-n // span) * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - span + 1], ahead[span - 1 : n])


def _slices(texts: list[bytes], width: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text's place, offset in it, bytes) in lots of about SLICE bytes; each string of ``width`` is in one slice."""
    lot, size = [], 0
    for row, text in enumerate(texts):
        for offset in range(0, len(text) - width + 1, SLICE):
            lot.append((row, offset, text[offset : offset + SLICE + width - 1]))
            size += len(lot[-1][2])
            if size >= SLICE:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def _anchors(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            texts = grams.text_bytes(batch.column(1))
            prints = np.array([xxh3_64_intdigest(t) for t in texts], dtype=np.uint64)
            for lot in _slices(texts, width):
                joined = b"".join(s for _, _, s in lot)
                sizes = np.array([len(s) for _, _, s in lot])
                begins = np.cumsum(sizes) - sizes
                hashes = gram_hashes(np.frombuffer(joined, dtype=np.uint8), gram, powers)
                # The greater place wins among equal hashes.
                backwards = _PLACE - np.arange(len(hashes), dtype=np.uint64)
                least = least_in_windows((hashes & ~_PLACE) | backwards, width - gram + 1)
                chosen = (_PLACE - (least & _PLACE)).astype(np.int64)
                owner = np.repeat(np.arange(len(lot)), sizes)
                starts = np.flatnonzero(owner[: len(joined) - width + 1] == owner[width - 1 :])
                kept = chosen[starts]
                firsts = np.flatnonzero(np.append(True, (kept[1:] != kept[:-1]) | (np.diff(starts) != 1)))
                lasts = starts[np.append(firsts[1:], len(starts)) - 1]
                anchor, firsts = hashes[kept[firsts]], starts[firsts]
                places = kept[np.searchsorted(starts, firsts)]
                view = memoryview(joined)
                reach = [xxh3_64_intdigest(view[a : b + width]) for a, b in zip(firsts.tolist(), lasts.tolist())]
                # Half of what a string has beside its anchor, before and after it; null where the slice ends before.
                half = (width - gram) // 2
                begin, end = begins[owner[firsts]], (begins + sizes)[owner[firsts]]
                sides = []
                for low, high in ((places - half, places + gram), (places, places + gram + half)):
                    inside = (low >= begin) & (high <= end)
                    found = [
                        xxh3_64_intdigest(view[a:b]) if ok else 0
                        for a, b, ok in zip(low.tolist(), high.tolist(), inside.tolist())
                    ]
                    sides.append(pa.array(grams.signed(np.array(found, dtype=np.uint64)), mask=~inside))
                slice_of = owner[firsts]
                shift = np.array([offset for _, offset, _ in lot])[slice_of] - begins[slice_of]
                row = np.array([r for r, _, _ in lot])[slice_of]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.signed(anchor)),
                        batch.column(0).take(pa.array(row)),
                        pa.array(grams.signed(prints[row])),
                        pa.array((firsts + shift).astype(np.int32)),
                        pa.array((lasts + shift).astype(np.int32)),
                        pa.array((places + shift).astype(np.int32)),
                        *sides,
                        pa.array(grams.signed(np.array(reach, dtype=np.uint64))),
                    ],
                    names=["anchor", "id", "print", "first", "last", "place", "left", "right", "reach"],
                )

    return docs.mapInArrow(run, _ANCHORS)


_ANCHORS = (
    "anchor bigint, id bigint, print bigint, first int, last int, place int, left bigint, right bigint, reach bigint"
)


def _with_print(docs: DataFrame) -> DataFrame:
    """Add a hash of the text to (id, text): a row is known by both, so rows may repeat an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = grams.text_bytes(batch.column(1))
            prints = np.array([xxh3_64_intdigest(t) for t in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(grams.signed(prints)), pa.array(texts, type=pa.binary())],
                names=["id", "print", "text"],
            )

    return docs.mapInArrow(run, "id bigint, print bigint, text binary")


_RESULT = "id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:int,end:int>>, kept binary"


def _removed(rows: DataFrame, as_digest: bool) -> DataFrame:
    """Rows (id, text, ranges to remove) finished."""
    kind = pa.string() if as_digest else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = grams.text_bytes(batch.column(1))
            sizes, removed, spans, kept = [], [], [], []
            for text, ranges in zip(texts, batch.column(2).to_pylist()):
                size = len(text)
                steps = np.zeros(size + 1, dtype=np.int32)
                for r in ranges or []:
                    steps[min(r["start"], size)] += 1
                    steps[min(r["end"], size)] -= 1
                own = spans_of(np.cumsum(steps)[:size] > 0) if ranges else []
                left, at = [], 0
                for s in own:
                    left.append(text[at : s["start"]])
                    at = s["end"]
                rest = b"".join([*left, text[at:]])
                sizes.append(size)
                removed.append(size - len(rest))
                spans.append(own)
                kept.append(hashlib.sha256(rest).hexdigest() if as_digest else rest)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, type=pa.int64()),
                    pa.array(removed, type=pa.int64()),
                    pa.array(spans, type=pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(kept, type=kind),
                ],
                names=["id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return rows.mapInArrow(run, _RESULT.replace("kept binary", "kept string") if as_digest else _RESULT)


_FOUND = "anchor bigint, digest binary, starts array<int>, hi array<bigint>, lo array<bigint>, at array<int>, known array<boolean>"


def repeated_in(pieces: list[bytes], width: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each piece the starts of strings that occur twice in the pieces, and of the first string of each kind."""
    sizes = np.array([len(p) for p in pieces])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.empty(int(sizes.sum()) + len(pieces), dtype=np.int64)
    for number, (piece, at) in enumerate(zip(pieces, begins)):
        text[at : at + len(piece)] = np.frombuffer(piece, dtype=np.uint8)
        text[at + len(piece)] = 256 + number  # in no other piece, so nothing is common beyond it
    suffixes = suffix_array(text)
    before, common = permuted_common_prefixes(text, suffixes)
    long = common >= width
    repeats = long.copy()
    repeats[before[long]] = True
    starts, firsts = [], []
    for at, size in zip(begins, sizes):
        own = slice(at, at + size - width + 1)
        starts.append(np.flatnonzero(repeats[own]))
        firsts.append(np.flatnonzero(~long[own]))
    return starts, firsts


def _shards(contents: DataFrame, width: int) -> DataFrame:
    """Sort the suffixes of the pieces (anchor, salt, salts, digest, content, copies), which come sorted by anchor and salt."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        found, firsts = repeated_in([r[4] for r in rows], width)
        columns = {name: [] for name in ("starts", "hi", "lo", "at", "known")}
        for (_, _, salts, _, content, copies), starts, kinds in zip(rows, found, firsts):
            if copies > 1:
                starts = np.arange(len(content) - width + 1)
            columns["starts"].append(starts.astype(np.int32))
            if salts == 1:
                kinds = kinds[:0]
            both = np.frombuffer(b"".join(xxh3_128_digest(content[k : k + width]) for k in kinds), dtype=">i8")
            both = both.astype(np.int64).reshape(-1, 2)
            columns["hi"].append(both[:, 0])
            columns["lo"].append(both[:, 1])
            columns["at"].append(kinds.astype(np.int32))
            columns["known"].append(np.isin(kinds, starts))
        kinds = {"starts": pa.int32(), "hi": pa.int64(), "lo": pa.int64(), "at": pa.int32(), "known": pa.bool_()}
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], type=pa.int64()),
                pa.array([r[3] for r in rows], type=pa.binary()),
                *[pa.array(columns[name], type=pa.list_(kind)) for name, kind in kinds.items()],
            ],
            names=["anchor", "digest", *kinds],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if size >= SHARD_BYTES and row[:2] != rows[-1][:2]:
                    yield solved(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield solved(rows)

    return contents.mapInArrow(run, _FOUND)


def suffix_dedup(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    gram: int = GRAM,
    split: int = SPLIT,
    as_digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_bytes, n_removed, spans (byte ranges removed), kept.

    Texts are UTF-8 bytes. A byte goes if it lies in a string of ``width`` bytes that
    also starts anywhere else, in the same text or another; strings are judged on the
    input and do not cross texts. ``kept`` is the remaining bytes, or with
    ``as_digest`` their SHA-256 in hexadecimal.

    A null text is empty. Every row counts, also one that repeats another or whose id
    is null, so a row that repeats a text of ``width`` bytes or more loses all of it.
    No rows give no rows; other columns are ignored. Ids must be integers.
    """
    number = F.col(f"`{id_column}`").cast("bigint")
    source = docs.select(
        F.coalesce(number, F.lit(_NO_ID)).alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    anchors = _anchors(source, width, gram)
    folder = scratch.folder("texts")
    with Scratch(docs.sparkSession) as passing:
        shared = anchors.groupBy("anchor").agg(
            F.count(F.lit(1)).alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high")
        )
        shared = shared.where("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("even"))
        shared = passing.keep(shared, "shared")
        ranges = passing.keep(anchors.drop("reach").join(shared, "anchor"), "ranges")
        still_open = _narrowed(ranges.where("NOT even"), (width - gram) // 2)
        even = ranges.where("even").select(*still_open.drop("n").columns, F.lit(1).cast("bigint").alias("n"))
        one = F.struct("anchor", "n", "first", "last", "even")
        # At most one range for each anchor of a text, and as a set once for all rows of the same id and text: no
        # longer than the text.
        of_document = even.unionByName(still_open).groupBy("id", "print").agg(F.collect_set(one).alias("ranges"))
        joined = _with_print(source).join(of_document, ["id", "print"], "left")
        split_up = joined.select(
            "id",
            "print",
            "text",
            F.transform(
                F.filter("ranges", lambda r: r["even"]),
                lambda r: F.struct(r["first"].alias("start"), (r["last"] + width).alias("end")),
            ).alias("even"),
            F.filter("ranges", lambda r: ~r["even"]).alias("open"),
        )
        split_up.write.option("compression", "zstd").parquet(folder)
    texts = docs.sparkSession.read.schema(split_up.schema).parquet(folder)

    pieces = texts.where(F.size("open") > 0).select("id", "print", "text", F.inline("open"))
    content = F.expr(f"substring(text, first + 1, last - first + {int(width)})")
    pieces = pieces.select("id", "print", "anchor", "n", "first", content.alias("content"))
    contents = pieces.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    digest = F.unhex(F.md5("content"))
    contents = contents.select("anchor", "content", "copies", digest.alias("digest"), F.ceil(F.col("n") / split).alias("salts"))
    contents = contents.select("*", F.pmod(F.xxhash64("digest"), F.col("salts")).alias("salt"))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = contents.repartition(partitions, "anchor", "salt").sortWithinPartitions("anchor", "salt")
    found = _shards(dealt.select("anchor", "salt", "salts", "digest", "content", "copies"), width)
    found = scratch.keep(found, "found")

    kinds = found.select("anchor", "digest", F.inline(F.arrays_zip("hi", "lo", "at", "known")))
    across = kinds.groupBy("anchor", "hi", "lo").agg(F.count(F.lit(1)).alias("n"), F.bool_or(~F.col("known")).alias("new"))
    across = across.where("n > 1 AND new").select("anchor", "hi", "lo")
    more = kinds.where("NOT known").join(across, ["anchor", "hi", "lo"]).groupBy("anchor", "digest").agg(F.collect_list("at").alias("starts"))
    starts = found.where(F.size("starts") > 0).select("anchor", "digest", "starts").unionByName(more)
    spans = pieces.select("id", "print", "anchor", "first", digest.alias("digest")).join(starts, ["anchor", "digest"])
    spans = spans.select("id", "print", F.col("first"), F.explode(_runs("starts")).alias("run"))
    start = F.col("first") + F.col("run.start")
    end = F.col("first") + F.col("run.end") + (width - 1)
    # Rows of the same id and text have the same spans, so these are a set.
    spans = spans.groupBy("id", "print").agg(F.collect_set(F.struct(start.alias("start"), end.alias("end"))).alias("more"))
    nothing = F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")
    last = texts.select("id", "print", "text", "even").join(spans, ["id", "print"], "left")
    last = last.select("id", "text", F.concat(F.coalesce("even", nothing), F.coalesce("more", nothing)).alias("ranges"))
    finished = _removed(last, as_digest)
    shown = F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_column)
    return finished.select(shown, "n_bytes", "n_removed", "spans", "kept")


def _narrowed(ranges: DataFrame, half: int) -> DataFrame:
    """Of each anchor's strings those that can repeat.

    A string has ``half`` bytes before its anchor or more than that after it. So where
    nothing else has the same half before the anchor, only strings that start less than
    ``half`` before it can repeat, and where nothing has the same half after it only the
    others; with neither, none can.
    """
    for side in ("left", "right"):
        twice = ranges.where(F.col(side).isNotNull()).groupBy("anchor", side).agg(F.count(F.lit(1)).alias("n"))
        twice = twice.where("n > 1").select("anchor", side, F.lit(True).alias(f"{side}_twice"))
        ranges = ranges.join(twice, ["anchor", side], "left")
    border = F.col("place") - half
    first = F.when(F.col("left_twice"), F.col("first")).otherwise(F.greatest("first", border + 1))
    last = F.when(F.col("right_twice"), F.col("last")).otherwise(F.least("last", border))
    ranges = ranges.where("left_twice OR right_twice").select("anchor", "id", "print", "even", first.alias("first"), last.alias("last"))
    ranges = ranges.where("first <= last")
    return ranges.join(ranges.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "anchor")


def _runs(starts: str):
    """Ascending numbers as half-open runs (start, end) of consecutive ones."""
    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int>>")
    both = F.aggregate(
        F.array_sort(F.col(starts)),
        F.struct(empty.alias("done"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end")),
        lambda acc, x: F.when(
            acc["end"].eqNullSafe(x), F.struct(acc["done"].alias("done"), acc["start"].alias("start"), (x + 1).alias("end"))
        ).otherwise(
            F.struct(
                F.when(acc["start"].isNull(), acc["done"])
                .otherwise(
                    F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))
                )
                .alias("done"),
                x.alias("start"),
                (x + 1).alias("end"),
            )
        ),
        lambda acc: F.concat(acc["done"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end")))),
    )
    return both
