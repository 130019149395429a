"""Token ids of documents in files of entropy-coded blocks.

Tokenizing writes the ids once, raw, with counts of all ids; the counts give one
frequency table for all blocks. Then the rows are dealt out by ranges of the
document id, and every range is encoded by one task into blocks of whole documents
in ascending order. The files are Parquet: a row is a block with its documents'
ids and lengths, the coded stream, checkpoints and checksums, so blocks are read
and decoded in parallel and a damaged one is found.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weftgraph.llm import counts, rans
from weftgraph.scratch import Scratch

# Ids in a block, unless one document is longer.
BLOCK_IDS = 1 << 20
# Texts tokenized at once, and pieces that a worker remembers (about 150 bytes each).
_TEXTS = 300
_CACHED = 600_000
_CELLS = 1 << 12
# Where a byte-level tokenizer always starts a new piece: at a space and around a line feed, each alone between other
# characters.
_WORD = re.compile(r" (?<=\S )(?=\S)")
_LINE = re.compile(r"\n(?<=\S\n)(?=\S)")
# Pieces that are encoded as one text.
_TOGETHER = 256


def _words(line: str) -> list[str]:
    words = line.split()
    # Most lines have single spaces only, for which this is faster.
    return words if words and " ".join(words) == line else _WORD.split(line)


class TokenFileError(ValueError):
    """A block does not decode to what was written."""


class Encoder:
    """A tokenizer with a cache of pieces, so that a piece which comes again is not encoded again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        feed = self._ids(["\n"])[0]
        self.cuts = _cuts_at_spaces(path) and len(feed) == 1
        self.feed = feed.tobytes()
        self.endings = {c: ids.tobytes() for c, ids in zip(".,", self._ids([".", ","]))}
        # By piece: after a space, and at the start of a line.
        self.later: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in coded]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The tokenizer's ids of each text."""
        if not self.cuts:
            return self._ids(texts)
        lines = [[_words(line) for line in _LINE.split(text)] for text in texts]
        later = self._coded(self.later, [p for own in lines for line in own for p in line[1:]], " ")
        first = self._coded(self.first, [line[0] for own in lines for line in own], "")
        found, at, line_at = [], 0, 0
        for own in lines:
            coded = []
            for line in own:
                coded += self.feed, first[line_at], *later[at : at + len(line) - 1]
                line_at += 1
                at += len(line) - 1
            found.append(np.frombuffer(b"".join(coded[1:]), dtype=self.kind))
        return found

    def _coded(self, cache: dict[str, bytes], pieces: list[str], before: str) -> list[bytes]:
        coded = list(map(cache.get, pieces))
        missing = [i for i, c in enumerate(coded) if c is None]
        if missing:
            new = self._learned(cache, {pieces[i] for i in missing}, before)
            for i in missing:
                coded[i] = new[pieces[i]]
            if len(cache) + len(new) > _CACHED:
                cache.clear()
            cache |= new
        return coded

    def _learned(self, known: dict[str, bytes], new: set[str], before: str) -> dict[str, bytes]:
        # A full stop or comma after a letter is a piece of its own, so the word before it may be known.
        ending = {p for p in new if p[-1:] in self.endings and p[-2:-1].isalpha()}
        found = self._encoded((new - ending) | {p[:-1] for p in ending if p[:-1] not in known}, before)
        for p in ending:
            found[p] = (found.get(p[:-1]) or known[p[:-1]]) + self.endings[p[-1]]
        return found

    def _encoded(self, new: set[str], before: str) -> dict[str, bytes]:
        plain, odd, found = [], [], {}
        for p in new:
            # White space at an end would join the line feed.
            (odd if "\n" in p or not p or p != p.strip() else plain).append(p)
        lots = [plain[i : i + _TOGETHER] for i in range(0, len(plain), _TOGETHER)]
        # Line feeds between the pieces come back as ids of their own, and tell the pieces apart.
        joined = self._ids(["\n".join([before + p for p in lot]) for lot in lots])
        for lot, ids in zip(lots, joined):
            raw, feeds = ids.tobytes(), np.flatnonzero(ids == np.frombuffer(self.feed, dtype=self.kind)[0])
            size, ends = ids.itemsize, [*feeds.tolist(), len(ids)]
            at = 0
            for p, end in zip(lot, ends, strict=True):
                found[p] = raw[at * size : end * size]
                at = end + 1
        for p, ids in zip(odd, self._ids([before + p for p in odd])):
            found[p] = ids.tobytes()
        return found


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker, which keeps its cache from task to task."""
    return Encoder(path)


def _cuts_at_spaces(path: str) -> bool:
    """Whether this is a byte-level tokenizer whose pieces do not depend on what is around them."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    before = model.get("pre_tokenizer") or {}
    return (
        model.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and not any(
            re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in model.get("added_tokens", [])
        )
    )


_TOKENS = f"place bigint, id bigint, raw binary, {counts.COLUMNS}"


def tokenized(docs: DataFrame, path: str, end_id: int, vocabulary: int) -> DataFrame:
    """Per row of ``docs`` (place, id, text) its place, id and raw ids with the end id; besides, each task's counts in chunks."""
    cells = -(-vocabulary // _CELLS) * _CELLS
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, seen = encoder(path), np.zeros(cells, dtype=np.int64)
        end = np.array(end_id, dtype=kind)
        names = ["place", "id", "raw", "chunk", "counts"]
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for start in range(0, len(texts), _TEXTS):
                ids = [np.append(x, end) for x in coder.encode(texts[start : start + _TEXTS])]
                seen += np.bincount(np.concatenate(ids), minlength=cells)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(ids)),
                        batch.column(1).slice(start, len(ids)),
                        pa.array([x.astype(kind).tobytes() for x in ids], type=pa.binary()),
                        pa.nulls(len(ids), pa.int32()),
                        pa.nulls(len(ids), pa.binary()),
                    ],
                    names=names,
                )
        own = counts.chunked(seen, _CELLS)
        yield pa.RecordBatch.from_arrays(
            [*[pa.nulls(len(own), pa.int64())] * 2, pa.nulls(len(own), pa.binary()), *own.columns], names=names
        )

    return docs.mapInArrow(run, _TOKENS)


_BLOCK = (
    "part int, block int, before bigint, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, "
    "stream binary, places array<bigint>, states binary, stream_crc bigint, ids_crc bigint"
)


def _encoded(rows: DataFrame, table, raw_kind: str) -> DataFrame:
    """Blocks of the rows (part, id, raw), which come in order within a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rans.Coder(table.value)
        part, number, before, docs, texts, size = None, 0, 0, [], [], 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate(texts)
            stream, places, states = coder.encode(ids)
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": part,
                        "block": number,
                        "before": before,
                        "doc_ids": docs,
                        "lengths": [len(t) for t in texts],
                        "n_ids": len(ids),
                        "stream": stream.tobytes(),
                        "places": places.tolist(),
                        "states": states.tobytes(),
                        "stream_crc": zlib.crc32(stream.tobytes()),
                        "ids_crc": zlib.crc32(ids.astype("<u4").tobytes()),
                    }
                ],
                schema=_BLOCK_SCHEMA,
            )

        for batch in batches:
            for at, doc, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                part = at
                docs.append(doc)
                texts.append(np.frombuffer(raw, dtype=raw_kind))
                size += len(texts[-1])
                if size >= BLOCK_IDS:
                    yield block()
                    number, before, docs, texts, size = number + 1, before + size, [], [], 0
        if docs:
            yield block()

    return rows.mapInArrow(run, _BLOCK)


_LONGS = pa.list_(pa.int64())
_BLOCK_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("before", pa.int64()),
        ("doc_ids", _LONGS),
        ("lengths", _LONGS),
        ("n_ids", pa.int64()),
        ("stream", pa.binary()),
        ("places", _LONGS),
        ("states", pa.binary()),
        ("stream_crc", pa.int64()),
        ("ids_crc", pa.int64()),
    ]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    vocabulary: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    place: Column | None = None,
    part_rows: int = 1 << 20,
) -> None:
    """Write the ids of all documents below ``path``: ``blocks`` and the frequency ``table``.

    Documents are in ascending order of the integer id, or first of ``place`` if that
    is given; null comes first, and rows that repeat an id come in any order. A null text is empty and has the end id alone. No documents
    give no blocks; other columns are ignored. A task encodes one range of at most
    about ``part_rows`` documents, so parts grow in number, not in size.
    """
    number = F.col(f"`{id_column}`").cast("bigint")
    source = docs.select(
        (number if place is None else place).cast("bigint").alias("place"),
        number.alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
    )
    spark = docs.sparkSession
    with Scratch(spark) as passing:
        folder = passing.folder("tokens")
        tokenized(source, tokenizer, end_id, vocabulary).write.option("compression", "zstd").parquet(folder)
        kept = spark.read.schema(_TOKENS).parquet(folder)
        cells = -(-vocabulary // _CELLS) * _CELLS
        frequency = rans.frequencies(counts.summed(kept.where(F.col("chunk").isNotNull()), cells, _CELLS))
        table = spark.sparkContext.broadcast(frequency)
        spark.createDataFrame(
            [(int(i), int(frequency[i])) for i in np.flatnonzero(frequency)], "token_id int, frequency bigint"
        ).coalesce(1).write.parquet(f"{path}/table")

        rows = kept.where(F.col("raw").isNotNull()).select("place", "id", "raw")
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // part_rows))
        ranged = rows.repartitionByRange(partitions, "place", "id").sortWithinPartitions("place", "id")
        ranged = ranged.select(F.spark_partition_id().alias("part"), "id", "raw")
        blocks = _encoded(ranged, table, "<u2" if vocabulary <= 1 << 16 else "<u4")
        blocks.write.option("compression", "none").parquet(f"{path}/blocks")


_IDS = "doc_id bigint, start bigint, ids array<int>"
_DIGESTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_files(
    spark: SparkSession, path: str, scratch: Scratch, vocabulary: int, as_digest: bool = False
) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), ids.

    With ``as_digest`` n_tokens and ids_crc32 take the place of the ids: their number,
    and the crc32 of them as little-endian unsigned 32-bit integers. Raises
    ``TokenFileError`` where a block's stream or its ids differ from their checksums.
    """
    pairs = spark.read.schema("token_id int, frequency bigint").parquet(f"{path}/table").collect()
    frequency = np.zeros(vocabulary, dtype=np.uint64)
    for row in pairs:
        frequency[row["token_id"]] = row["frequency"]
    table = spark.sparkContext.broadcast(frequency)
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # A block has the ids of its part before it; the parts' own numbers of ids are one row each. They are
    # written, so that their size is known when Spark plans the join.
    of_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = of_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("part_start"))
    starts = scratch.keep(starts, "starts")
    placed = blocks.join(starts, "part").withColumn("start", F.col("part_start") + F.col("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rans.Coder(table.value)
        for batch in batches:
            for b in batch.to_pylist():
                stream = np.frombuffer(b["stream"], dtype="<u4")
                states = np.frombuffer(b["states"], dtype="<u8").reshape(-1, rans.LANES)
                where = f"block {b['block']} of part {b['part']}"
                if zlib.crc32(b["stream"]) != b["stream_crc"]:
                    raise TokenFileError(f"{where}: the stream is damaged")
                ids = coder.decode(stream, b["n_ids"], np.array(b["places"], dtype=np.int64), states)
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != b["ids_crc"]:
                    raise TokenFileError(f"{where}: the ids are not those that were written")
                lengths = np.array(b["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                both = [pa.array(b["doc_ids"], type=pa.int64()), pa.array(b["start"] + ends - lengths)]
                if as_digest:
                    sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                    both += pa.array(lengths), pa.array(sums, type=pa.int64())
                else:
                    offsets = pa.array(np.append(0, ends).astype(np.int32))
                    both.append(pa.ListArray.from_arrays(offsets, pa.array(ids.view(np.int32))))
                names = ["doc_id", "start", *(("n_tokens", "ids_crc32") if as_digest else ("ids",))]
                yield pa.RecordBatch.from_arrays(both, names=names)

    return placed.mapInArrow(run, _DIGESTS if as_digest else _IDS)
