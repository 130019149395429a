"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in pieces of ``PIECE`` bytes, forwards and backwards, and
labels every byte with probabilities of the languages; a document's probability is
the mean over the bytes of its letters. It is trained here, in numpy, by
backpropagation through time on a sample: ``PER_LANGUAGE`` documents of each label,
however many labels there are, ``SAMPLE_CHARS`` characters of each from a place given
by a hash. Updates grow with the number of labels. Prediction covers every byte of every text.

Gates are piecewise linear (a clipped line in place of the logistic function and of
the hyperbolic tangent), which numpy evaluates many times faster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from weftgraph.llm import grams

HIDDEN = 8
PIECE = 256
PER_LANGUAGE = 400
SAMPLE_CHARS = 512
TRAIN_PIECE = 96
TRAIN_BATCH = 128
# Updates at least, and for each label.
TRAIN_STEPS = 160
STEPS_PER_LANGUAGE = 5
# Pieces that go through the network side by side, and steps whose labels are made at once.
_SIDE_BY_SIDE = 2048
_AT_ONCE = 32
_LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"

_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[128:] = True
for _letters in (b"AZ", b"az"):
    _IS_LETTER[_letters[0] : _letters[1] + 1] = True


@dataclass
class Direction:
    """One reading direction. Rows of ``table`` and ``inner``: update gate, reset gate, candidate."""

    table: np.ndarray  # (3 * hidden, 256): what each byte adds, bias included
    inner: np.ndarray  # (3 * hidden, hidden)

    def run(self, codes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States (steps, hidden, batch) after each row of ``codes`` (steps, batch)."""
        size = self.inner.shape[1]
        steps, batch = codes.shape
        state = np.zeros((size, batch), dtype=np.float32)
        states = np.empty((steps, size, batch), dtype=np.float32)
        trace = []
        for t in range(steps):
            byte = self.table.take(codes[t], axis=1)
            back = self.inner @ state
            gates = byte[: 2 * size] + back[: 2 * size]
            gates *= np.float32(0.25)
            gates += np.float32(0.5)
            np.clip(gates, 0, 1, out=gates)
            update, reset = gates[:size], gates[size:]
            new = reset * back[2 * size :]
            new += byte[2 * size :]
            np.clip(new, -1, 1, out=new)
            if keep:
                trace.append((state, back[2 * size :], gates, new))
            state = new + update * (state - new)
            states[t] = state
        return states, trace

    def gradients(self, codes: np.ndarray, trace: list, above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of ``table`` and ``inner``, back through time; ``above`` is the gradient of each state."""
        size = self.inner.shape[1]
        steps, batch = codes.shape
        of_table = np.empty((steps, 3 * size, batch), dtype=np.float32)
        of_inner = np.zeros_like(self.inner)
        later = np.zeros((size, batch), dtype=np.float32)
        for t in range(steps - 1, -1, -1):
            before, back, gates, new = trace[t]
            update, reset = gates[:size], gates[size:]
            state = above[t] + later
            of_new = state * (1 - update) * (np.abs(new) < 1)
            inside = ((gates > 0) & (gates < 1)) * np.float32(0.25)
            of_update = state * (before - new) * inside[:size]
            of_reset = of_new * back * inside[size:]
            of_table[t] = np.concatenate([of_update, of_reset, of_new])
            of_back = np.concatenate([of_update, of_reset, of_new * reset])
            of_inner += of_back @ before.T
            later = state * update + self.inner.T @ of_back
        flat, places = of_table.transpose(1, 0, 2).reshape(3 * size, -1), codes.ravel()
        return np.stack([np.bincount(places, row, 256) for row in flat]).astype(np.float32), of_inner


@dataclass
class LanguageModel:
    languages: list[str]
    forwards: Direction
    backwards: Direction
    output: np.ndarray  # (languages, 2 * hidden + 1), bias last

    def _label(self, states: np.ndarray) -> np.ndarray:
        """Probabilities (steps, languages, batch) from both directions' states."""
        raw = self.output[:, :-1] @ states + self.output[:, -1:]
        raw -= raw.max(axis=1, keepdims=True)
        np.exp(raw, out=raw)
        raw /= raw.sum(axis=1, keepdims=True)
        return raw

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Per text the mean probabilities over its letters' bytes (0 where there are none)."""
        counts = np.array([-(-len(t) // PIECE) for t in texts])
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = b"".join(t.ljust(c * PIECE, b"\0") for t, c in zip(texts, counts))
        pieces = np.frombuffer(padded, dtype=np.uint8).reshape(-1, PIECE)
        total = np.zeros((len(texts), len(self.languages)))
        letters = np.bincount(owner, _IS_LETTER[pieces].sum(axis=1), len(texts))
        for start in range(0, len(pieces), _SIDE_BY_SIDE):
            codes = np.ascontiguousarray(pieces[start : start + _SIDE_BY_SIDE].T)
            ahead, _ = self.forwards.run(codes)
            behind = self.backwards.run(codes[::-1])[0][::-1]
            sums = np.zeros((len(self.languages), codes.shape[1]), dtype=np.float32)
            for t in range(0, PIECE, _AT_ONCE):
                part = slice(t, t + _AT_ONCE)
                labels = self._label(np.concatenate([ahead[part], behind[part]], axis=1))
                labels *= _IS_LETTER[codes[part]][:, None, :]
                sums += labels.sum(axis=0)
            np.add.at(total, owner[start : start + _SIDE_BY_SIDE], sums.T)
        return total / np.maximum(letters, 1)[:, None]


def training_steps(languages: int) -> int:
    return max(TRAIN_STEPS, STEPS_PER_LANGUAGE * languages)


def learned(texts: list[bytes], labels: list[str], seed: int = 11) -> LanguageModel:
    """Train on labelled texts, every position with its document's label. Deterministic."""
    random = np.random.default_rng(seed)
    languages = sorted(set(labels))
    number = {name: i for i, name in enumerate(languages)}

    def weights(*shape: int, scale: float) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    model = LanguageModel(
        languages,
        *[Direction(weights(3 * HIDDEN, 256, scale=0.3), weights(3 * HIDDEN, HIDDEN, scale=0.3)) for _ in range(2)],
        weights(len(languages), 2 * HIDDEN + 1, scale=0.1),
    )
    kept = [(t, number[n]) for t, n in zip(texts, labels) if t]
    of_language = [[t for t, n in kept if n == i] for i in range(len(languages))]
    present = [i for i, own in enumerate(of_language) if own]
    if not present:
        return model
    ways = [model.forwards, model.backwards]
    parameters = [model.output, *[p for w in ways for p in (w.table, w.inner)]]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    steps = training_steps(len(present))
    for step in range(1, steps + 1):
        target = random.choice(present, TRAIN_BATCH)
        rows = []
        for i in target:
            text = of_language[i][random.integers(len(of_language[i]))]
            at = random.integers(max(1, len(text) - TRAIN_PIECE + 1))
            rows.append(text[at : at + TRAIN_PIECE].ljust(TRAIN_PIECE, b"\0"))
        codes = np.ascontiguousarray(np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(TRAIN_BATCH, -1).T)
        counted = _IS_LETTER[codes].astype(np.float32)
        ahead, trace_ahead = model.forwards.run(codes, keep=True)
        behind, trace_behind = model.backwards.run(codes[::-1], keep=True)
        states = np.concatenate([ahead, behind[::-1]], axis=1)
        error = model._label(states)
        error[:, target, np.arange(TRAIN_BATCH)] -= 1
        error *= counted[:, None, :] / max(1.0, float(counted.sum()))
        of_output = np.empty_like(model.output)
        of_output[:, :-1] = np.einsum("tlb,thb->lh", error, states, optimize=True)
        of_output[:, -1] = error.sum(axis=(0, 2))
        of_states = model.output[:, :-1].T @ error
        gradients = [
            of_output,
            *model.forwards.gradients(codes, trace_ahead, of_states[:, :HIDDEN]),
            *model.backwards.gradients(codes[::-1], trace_behind, of_states[::-1, HIDDEN:]),
        ]
        size = float(np.sqrt(sum((g * g).sum() for g in gradients)))
        rate = 0.03 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, mean, square in zip(parameters, gradients, means, squares):
            g = g / max(1.0, size)
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            p -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return model


def held_out(doc_id: Column, remainder: int = 1, of: int = 3) -> Column:
    """Whether a document is kept out of training, by the crc32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of == remainder


def labelled_sample(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang"
) -> tuple[list[bytes], list[str]]:
    """At most PER_LANGUAGE rows of each label, not held out, spread by a hash.

    Rows whose id, text or label is null are left out. Before rows are ranked, a
    share of each label's rows is taken by the hash, so that ranking handles a few
    times the wanted number whatever the table holds.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{text_column}`").cast("string").alias("text"),
        F.col(f"`{label_column}`").cast("string").alias("label"),
    ).where("id IS NOT NULL AND text IS NOT NULL AND label IS NOT NULL")
    rows = rows.where(~held_out(F.col("id")))
    found = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["label"]: r["n"] for r in found.collect()}
    if not counts:
        return [], []
    scale = 1 << 30
    shares = [(label, int(scale * min(1.0, 4 * PER_LANGUAGE / n))) for label, n in sorted(counts.items())]
    share = docs.sparkSession.createDataFrame(shares, "label string, share bigint")
    mark = F.pmod(F.xxhash64("id", "text"), F.lit(scale))
    taken = rows.select("id", "text", "label", mark.alias("mark")).join(F.broadcast(share), "label").where("mark < share")
    place = 1 + F.pmod(F.xxhash64("text", "id"), F.greatest(F.char_length("text") - SAMPLE_CHARS + 1, F.lit(1)))
    ranked = taken.select(
        "label",
        F.substr("text", place.cast("int"), F.lit(SAMPLE_CHARS)).alias("piece"),
        F.row_number().over(Window.partitionBy("label").orderBy("mark", "id")).alias("rank"),
    )
    sample = ranked.where(F.col("rank") <= PER_LANGUAGE).orderBy("label", "rank").collect()
    return [r["piece"].encode() for r in sample], [r["label"] for r in sample]


def identify(
    docs: DataFrame,
    model: LanguageModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: bool = False,
    into: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """One row per row of ``docs``: its id, lang_pred, score (0 to 1); with ``keep`` the row's own columns come first.

    A null text, one without a letter, and any text under a model that has learned
    no language, is ``und`` with score 0. Ids may repeat or be null: rows are judged
    one by one. ``into`` names the new columns; own columns of these names give way to them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts = batch.column(at).to_pylist()
            start = 0
            while start < len(texts):
                end, size = start, 0
                while end < len(texts) and (end == start or size < grams.BLOCK_BYTES):
                    size += len(texts[end] or "")
                    end += 1
                part = texts[start:end]
                names, scores = [UNDETERMINED] * len(part), np.zeros(len(part))
                judged = [i for i, t in enumerate(part) if t and _LETTER.search(t)] if model.languages else []
                if judged:
                    found = model.pooled([part[i].encode() for i in judged])
                    best = found.argmax(axis=1)
                    scores[judged] = np.clip(found[np.arange(len(judged)), best], 0, 1)
                    for i, b in zip(judged, best):
                        names[i] = model.languages[b]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, end - start).columns, pa.array(names), pa.array(scores)],
                    names=[*batch.schema.names, *into],
                )
                start = end

    source = docs.drop(*into) if keep else docs.select(f"`{id_column}`", f"`{text_column}`")
    schema = source.limit(0).select("*", F.lit("").alias(into[0]), F.lit(0.0).alias(into[1])).schema
    found = source.mapInArrow(run, schema)
    return found if keep else found.select(f"`{id_column}`", *into)
