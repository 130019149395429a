"""Words and word windows of documents as numpy arrays; shared by the operators on windows.

A word is hashed to 128 bits (two lanes), a window of words by a polynomial over
the word hashes in each lane. The documents of an Arrow batch are cut into blocks
of bounded size, and each block is handled by a few numpy calls.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from xxhash import xxh3_128_digest

# Bytes of text in a block, unless one document is longer.
BLOCK_BYTES = 1 << 20
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_ASCII = bytes(range(128))
_LOWER = bytes(range(ord("A"), ord("Z") + 1)), bytes(range(ord("a"), ord("z") + 1))
LOWER_CASED = bytes.maketrans(*_LOWER)
# All ASCII but letters and digits parts words, and A-Z are lower-cased.
ALPHANUMERIC = bytes.maketrans(
    bytes(c for c in _ASCII if not chr(c).isalnum()) + _LOWER[0],
    b" " * sum(not chr(c).isalnum() for c in _ASCII) + _LOWER[1],
)


def plain_words(data: bytes) -> list[bytes]:
    """Runs of bytes other than ASCII white space (space, tab to carriage return)."""
    return data.split()


def lower_words(data: bytes) -> list[bytes]:
    """The same with A-Z lower-cased."""
    return data.translate(LOWER_CASED).split()


def alphanumeric_words(data: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all non-ASCII bytes, A-Z lower-cased."""
    return data.translate(ALPHANUMERIC).split()


@dataclass
class Block:
    """Some documents, their words laid end to end.

    ``rows`` are their places in the batch, ``counts`` their numbers of words, and
    ``starts`` the places of their first words. ``lanes`` has two hashes a word.
    """

    rows: np.ndarray
    counts: np.ndarray
    starts: np.ndarray
    lanes: tuple[np.ndarray, np.ndarray]

    @property
    def owner(self) -> np.ndarray:
        """For each word the place of its document in the block."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of all windows that stay in one document, and the documents' places in the block."""
        owner = self.owner
        if len(owner) < width:
            none = np.empty(0, dtype=np.int64)
            return none, none
        starts = np.flatnonzero(owner[: len(owner) - width + 1] == owner[width - 1 :])
        return starts, owner[starts]

    def hashes(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the window at each word, whether it stays in one document or not."""
        return rolled(self.lanes[0], width, BASES[0]), rolled(self.lanes[1], width, BASES[1])


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null becomes empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def packed(docs: DataFrame) -> DataFrame:
    """(id, text) with each text as a compressed ``pack``, which takes less room in a shuffle than Spark's own compression."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packs = pa.array([coder.compress(t) for t in text_bytes(batch.column(1))], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), packs], names=["id", "pack"])

    return docs.mapInArrow(run, "id bigint, pack binary")


def unpacked(packs: pa.Array) -> list[bytes]:
    coder = zstandard.ZstdDecompressor()
    return [coder.decompress(p) for p in packs.to_pylist()]


def blocks(texts: Iterable[bytes], split: Callable[[bytes], list[bytes]]) -> Iterator[Block]:
    rows, words, counts, size = [], [], [], 0
    for row, text in enumerate(texts):
        found = split(text)
        rows.append(row)
        counts.append(len(found))
        words += found
        size += len(text)
        if size >= BLOCK_BYTES:
            yield _block(rows, words, counts)
            rows, words, counts, size = [], [], [], 0
    if rows:
        yield _block(rows, words, counts)


def word_lanes(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(map(xxh3_128_digest, words)), dtype=">u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


def _block(rows: list[int], words: list[bytes], counts: list[int]) -> Block:
    sizes = np.array(counts, dtype=np.int64)
    return Block(np.array(rows, dtype=np.int64), sizes, np.cumsum(sizes) - sizes, word_lanes(words))


def rolled(lane: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    size = max(0, len(lane) - width + 1)
    found = np.zeros(size, dtype=np.uint64)
    for j in range(width):
        found *= base
        found += lane[j : j + size]
    return mixed(found)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of x over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def winnowed(grams: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """For each window start the place of the least of its ``span`` grams, the last of equals.

    The choice depends on the window's words alone, so equal windows choose the
    same gram wherever they are.
    """
    best, place = grams[starts], np.zeros(len(starts), dtype=np.int64)
    for j in range(1, span):
        other = grams[starts + j]
        less = other <= best
        best[less] = other[less]
        place[less] = j
    return starts + place


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None
