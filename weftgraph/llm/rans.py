"""A static range asymmetric numeral coder for blocks of token ids, in numpy.

All blocks share one frequency table. Within a block the ids are dealt over
``LANES`` interleaved states that move in step, so that a step is a few array
operations. Every ``INTERVAL`` steps the states and the place in the stream are
kept as a checkpoint, from which decoding can start.
"""

from __future__ import annotations

import numpy as np

LANES = 2048
INTERVAL = 512
SCALE_BITS = 20
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)
_MASK = np.uint64((1 << SCALE_BITS) - 1)


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2^SCALE_BITS, at least one for every id that occurs."""
    counts = counts.astype(np.float64)
    used = np.flatnonzero(counts)
    if not len(used):
        return np.zeros(len(counts), dtype=np.uint64)
    total = 1 << SCALE_BITS
    if len(used) > total:
        raise ValueError("more ids than the table can tell apart")
    scaled = np.zeros(len(counts), dtype=np.int64)
    scaled[used] = np.maximum(1, np.floor(counts[used] / counts.sum() * total))
    # What rounding left over goes to the most frequent ids, what it took too much comes from them.
    order = used[np.argsort(-counts[used], kind="stable")]
    rest = total - int(scaled.sum())
    for at in order:
        if rest == 0:
            break
        change = rest if rest > 0 else max(rest, 1 - int(scaled[at]))
        scaled[at] += change
        rest -= change
    return scaled.astype(np.uint64)


class Coder:
    def __init__(self, table: np.ndarray):
        self.freq = table.astype(np.uint64)
        self.first = np.cumsum(self.freq) - self.freq
        self.symbol = np.repeat(np.arange(len(table), dtype=np.uint32), self.freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The stream of 32-bit words; per checkpoint its place in the stream and its lanes' states."""
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, _LOW, dtype=np.uint64)
        pieces, places, states, written = [], [], [], 0
        for step in range(steps - 1, -1, -1):
            row = ids[step * LANES : (step + 1) * LANES]
            x, f = state[: len(row)], self.freq[row]
            full = x >= f << np.uint64(63 - SCALE_BITS)
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            x[full] >>= _WORD
            quotient = x // f
            x[:] = (quotient << _SCALE) + (x - quotient * f) + self.first[row]
            pieces.append(out)
            written += len(out)
            if step % INTERVAL == 0:
                places.append(written)
                states.append(state.copy())
        stream = np.concatenate(pieces[::-1]) if pieces else np.empty(0, dtype="<u4")
        # Decoding reads forwards: a place counts from the front.
        return stream, len(stream) - np.array(places[::-1], dtype=np.int64), np.array(states[::-1], dtype="<u8").reshape(-1, LANES)

    def decode(self, stream: np.ndarray, n: int, places: np.ndarray, states: np.ndarray, start: int = 0) -> np.ndarray:
        """Ids from checkpoint ``start`` to the end of the block of ``n`` ids."""
        first = start * INTERVAL * LANES
        found = np.empty(max(0, n - first), dtype=np.uint32)
        if not len(found):
            return found
        state, at = states[start].astype(np.uint64), int(places[start])
        for begin in range(0, len(found), LANES):
            x = state[: min(LANES, len(found) - begin)]
            slot = x & _MASK
            ids = self.symbol[slot]
            found[begin : begin + len(x)] = ids
            x[:] = self.freq[ids] * (x >> _SCALE) + slot - self.first[ids]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _WORD) | stream[at : at + len(low)]
            at += len(low)
        return found
