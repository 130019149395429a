"""Scoring texts by two models of the whole training corpus.

The first is a hashed maximum-entropy model with a class-factored softmax: a word's
probability is that of its class after the two words before it, times that of the word
in its class. The commonest words are classes of their own, all others are dealt to
classes by hash, and the end of a text is one. There are about as many classes as the
cube root of the number of distinct training words, so the table of how often each
class followed each two grows with the vocabulary. The class softmax adds the weights
of features of the context: the class before (2-gram), the two before (3-gram, hashed),
and the one before those skipping one. Within a class words follow their counts plus
one. The weights' gradient needs only how often each class followed each context,
which is counted over all training texts and stays in Spark; each update adds up the
gradients that tasks make of their share of the contexts.

The second is an interpolated word bigram model. A token's probability after the token
before it mixes, by Witten and Bell, how often it followed that token in training with
its add-one probability among all training tokens: (c(u, w) + T(u) * p(w)) /
(c(u) + T(u)), T(u) being the number of distinct tokens that followed u; a token never
followed in training keeps p(w).

Texts are read once, into slices of about a million tokens: a slice has a table of its
words, and numbers in place of words. All later passes read slices. A slice asks for the
counts of its distinct pairs by the first word's hash: every request for a pair, and all
that is known of its first word, meets in one bucket, where the slices' training counts
are added up, and the sums go back to the slices in the order of their requests. Pairs
of the commonest words are dealt to all buckets. A word follows the next as often as it
occurs, so the same sums are the counts of words. Nothing is left out or estimated.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from weftgraph.llm import counts, grams
from weftgraph.llm.language import held_out
from weftgraph.scratch import Scratch

# Classes at least: 24 words, 16 classes by hash, the end.
CLASSES = 41
# Contexts are the two classes before; the number of classes stands for the start of a text.
CONTEXTS = (CLASSES + 1) ** 2
UPDATES = 12
# Tokens of a slice, unless one document is longer, and about how many ask in one bucket.
SLICE_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 21

# The start of a text and its end, among the words' 64-bit hashes.
_START, _END = 1, 0


def _squeezed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, compressed byte by byte: first all lowest bytes, and so on."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _loosened(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(data[0], -1)
    found = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    found[:, : data[0]] = planes.T
    return found.view("<u8").ravel().astype(np.int64)


class Slice:
    """The tokens of some texts, ends included, by their places in ``hashes``: the slice's words, then the end and the start of a text.

    ``token`` and ``before`` are each token and the one before it, ``owner`` its text and ``ends`` the places of the ends.
    """

    def __init__(self, words: bytes, places: bytes, held: list[bool], n_words: list[int]):
        own, sizes = np.frombuffer(words, dtype="<u8"), np.array(n_words, dtype=np.int64) + 1
        self.hashes = np.concatenate([own, np.array([_END, _START], dtype=np.uint64)])
        self.end, self.start = len(own), len(own) + 1
        self.owner, self.ends = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.cumsum(sizes) - 1
        self.token = np.full(len(self.owner), self.end, dtype=np.int32)
        is_word = np.ones(len(self.owner), dtype=bool)
        is_word[self.ends] = False
        self.token[is_word] = _loosened(places)
        self.before = self.behind(1)
        self.trains = ~np.array(held, dtype=bool)[self.owner]

    def behind(self, back: int) -> np.ndarray:
        found = np.full(len(self.token), self.start, dtype=np.int32)
        same = self.owner[back:] == self.owner[:-back]
        found[back:][same] = self.token[:-back][same]
        return found

    @staticmethod
    def read(batch: pa.RecordBatch | pa.Table) -> Iterator[Slice]:
        columns = [batch.column(c).to_pylist() for c in ("words", "places", "held_out", "n_words")]
        yield from (Slice(*row) for row in zip(*columns))


def _slices(texts: DataFrame, size: int) -> DataFrame:
    """(id, held_out, n_words, words, places, tokens) of slices of the texts, see ``Slice``; the first three have a value for each text."""

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        words, n_words = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        distinct, places, times = np.unique(words, return_inverse=True, return_counts=True)
        # Common words come first, so that most places are small numbers.
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        lists = [pa.concat_arrays([p[i] for p in parts]) for i in (2, 3)] + [pa.array(n_words)]
        offsets = pa.array([0, len(n_words)], type=pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                *[pa.ListArray.from_arrays(offsets, values) for values in lists],
                pa.array([distinct[order].astype("<u8").tobytes()], type=pa.binary()),
                pa.array([_squeezed(rank[places])], type=pa.binary()),
                pa.array([len(words) + len(n_words)]),
            ],
            names=["id", "held_out", "n_words", "words", "places", "tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, found = [], 0
        for batch in batches:
            for block in grams.blocks(grams.text_bytes(batch.column(2)), grams.lower_words):
                taken = pa.array(block.rows)
                parts.append((block.lanes[0], block.counts, batch.column(0).take(taken), batch.column(1).take(taken)))
                found += len(block.lanes[0]) + len(block.counts)
                if found >= size:
                    yield packed(parts)
                    parts, found = [], 0
        if parts:
            yield packed(parts)

    schema = "id array<bigint>, held_out array<boolean>, n_words array<bigint>, words binary, places binary, tokens bigint"
    return texts.select("id", "held_out", "text").mapInArrow(run, schema)


def _word_counts(slices: DataFrame) -> DataFrame:
    """(w, c1): the training tokens, ends included, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in Slice.read(batch):
                times = np.bincount(part.token[part.trains], minlength=part.start)
                seen = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array(grams.signed(part.hashes[seen])), pa.array(times[seen])], names=["w", "n"])

    found = slices.select("words", "places", "held_out", "n_words").mapInArrow(run, "w bigint, n bigint")
    return found.groupBy("w").agg(F.sum("n").alias("c1"))


@dataclass
class Classes:
    """How words are dealt to classes: the commonest by themselves, in ascending order, then ``hashed`` ones, then the end.

    ``tokens`` and ``words`` are the classes' numbers of training tokens and of distinct training words.
    """

    own: np.ndarray
    hashed: int
    tokens: np.ndarray
    words: np.ndarray

    @property
    def size(self) -> int:
        return len(self.tokens)

    def of(self, words: np.ndarray) -> np.ndarray:
        hashed = self.size - 1 - self.hashed + ((words >> np.uint64(40)) % np.uint64(self.hashed)).astype(np.int64)
        at = np.minimum(np.searchsorted(self.own, words), max(0, len(self.own) - 1))
        return np.where(self.own[at] == words, at, hashed) if len(self.own) else hashed

    def common(self, words: np.ndarray) -> np.ndarray:
        """Places of words that have classes of their own, and behind them the start of a text; -1 for other words."""
        at = self.of(words)
        return np.where(words == _START, len(self.own), np.where(at < self.size - 1 - self.hashed, at, -1))

    def sequences(self, part: Slice) -> tuple[np.ndarray, np.ndarray]:
        """Context and class of every token of a slice."""
        of_word = np.append(self.of(part.hashes[: part.end]), [self.size - 1, self.size])
        return of_word[part.before] * (self.size + 1) + of_word[part.behind(2)], of_word[part.token]


def word_classes(words: DataFrame, distinct: int) -> Classes:
    """From the written counts (w, c1) of training tokens; only the words with classes of their own come to the driver."""
    size = max(CLASSES, int(np.ceil(distinct ** (1 / 3))))
    n_own = (size - 1) * 3 // 5
    hashed = size - 1 - n_own
    top = words.where(F.col("w") != _END).orderBy(F.desc("c1"), "w").limit(n_own).collect()
    own = np.sort(np.array([r["w"] for r in top], dtype=np.int64).view(np.uint64))
    tokens, kinds = np.zeros(size), np.zeros(size)
    found = Classes(own, hashed, tokens, kinds)
    by_hash = F.pmod(F.shiftrightunsigned("w", 40), F.lit(hashed)).cast("int")
    some = words.where(F.col("w") != _END).groupBy(by_hash.alias("class")).agg(F.sum("c1").alias("n"), F.count(F.lit(1)).alias("words"))
    for r in some.collect():
        tokens[n_own + r["class"]], kinds[n_own + r["class"]] = r["n"], r["words"]
    for r in top:
        word = np.array([r["w"]], dtype=np.int64).view(np.uint64)
        by_itself, at = found.of(word)[0], n_own + int(word[0] >> np.uint64(40)) % hashed
        tokens[by_itself], kinds[by_itself] = r["c1"], 1
        tokens[at] -= r["c1"]
        kinds[at] -= 1
    for r in words.where(F.col("w") == _END).collect():
        tokens[-1], kinds[-1] = r["c1"], 1
    return found


def _context_counts(slices: DataFrame, classes) -> DataFrame:
    """In training, how often each class followed the contexts of each class before: a chunk of ``counts`` for each that occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = classes.value
        for batch in batches:
            for part in Slice.read(batch):
                context, followed = model.sequences(part)
                cells, times = np.unique((context * model.size + followed)[part.trains], return_counts=True)
                chunk, cell = np.divmod(cells, (model.size + 1) * model.size)
                first = np.flatnonzero(np.diff(chunk, prepend=-1))
                ranges = list(zip(first, np.append(first[1:], len(chunk))))
                # The places of cells as steps from one to the next.
                steps = [_squeezed(np.diff(cell[a:b], prepend=0)) for a, b in ranges]
                counted = [_squeezed(times[a:b]) for a, b in ranges]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk[first].astype(np.int32)), pa.array(steps, type=pa.binary()), pa.array(counted, type=pa.binary())],
                    names=["chunk", "steps", "times"],
                )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, sums = classes.value.size, {}
        for batch in batches:
            for chunk, steps, times in zip(*[c.to_pylist() for c in batch.columns]):
                own = sums.setdefault(chunk, np.zeros((size + 1) * size, dtype=np.int64))
                own[np.cumsum(_loosened(steps))] += _loosened(times)
        for chunk, own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], type=pa.int32()), pa.array([own.astype("<u8").tobytes()], type=pa.binary())], names=["chunk", "counts"]
            )

    parts = slices.select("words", "places", "held_out", "n_words").mapInArrow(run, "chunk int, steps binary, times binary")
    return parts.repartition("chunk").mapInArrow(summed, counts.COLUMNS)


def _hashed_rows(states: int) -> int:
    """Rows of weights that the contexts of one class before share for their 3-grams."""
    return max(1, states // 2)


def feature_rows(classes: int = CLASSES) -> np.ndarray:
    """The rows of weights that each context adds up: (contexts, features).

    First come the bias and the rows of the class that is skipped to, then for each
    class before its own row and the hashed ones of its 3-grams.
    """
    states = classes + 1
    last, second = np.divmod(np.arange(states * states, dtype=np.int64), states)
    hashed = _hashed_rows(states)
    before = 1 + states + last * (1 + hashed)
    place = grams.mixed((last * states + second + (3 << 40)).astype(np.uint64)) % np.uint64(hashed)
    return np.stack([np.zeros_like(last), 1 + second, before, before + 1 + place.astype(np.int64)], axis=1)


def _log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    raw = weights[rows].sum(axis=1, dtype=np.float64)
    raw -= raw.max(axis=1, keepdims=True)
    return raw - np.log(np.exp(raw).sum(axis=1, keepdims=True))


def trained(seen: DataFrame, totals: np.ndarray, updates: int = UPDATES) -> np.ndarray:
    """Natural logarithms of class probabilities (contexts, classes), by distributed gradient updates.

    ``seen`` has, written, how often each class followed the contexts of a chunk, which
    are those of one class before; ``totals`` are the sums over all contexts. Steps are
    scaled per weight by the gradients so far.
    """
    classes, spark = len(totals), seen.sparkSession
    states = classes + 1
    rows, block = feature_rows(classes), 1 + _hashed_rows(states)
    weights = np.zeros((1 + states + states * block, classes), dtype=np.float32)
    weights[0] = np.log((totals + 1) / (totals.sum() + classes))
    past = np.zeros_like(weights)
    size = max(1.0, float(totals.sum()))
    for _ in range(updates if totals.sum() else 0):
        shared = spark.sparkContext.broadcast(weights)

        def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # Rows of weights that chunks have in common are added up by the task; the others are one chunk's alone.
            common = np.zeros((1 + states, classes))
            for batch in batches:
                for chunk, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    times = np.frombuffer(own, dtype="<u8").reshape(states, classes).astype(np.float64)
                    of_chunk = rows[chunk * states : (chunk + 1) * states]
                    error = np.exp(_log_softmax(shared.value, of_chunk)) * times.sum(axis=1, keepdims=True) - times
                    common[0] += error.sum(axis=0)
                    common[1:] += error
                    found = np.zeros((block, classes))
                    found[0] = error.sum(axis=0)
                    np.add.at(found, of_chunk[:, 3] - of_chunk[:, 2], error)
                    yield part(chunk, found)
            yield part(-1, common)

        def part(chunk: int, found: np.ndarray) -> pa.RecordBatch:
            numbers = pa.array([found.astype("<f4").tobytes()], type=pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([chunk], type=pa.int32()), numbers], names=["chunk", "counts"])

        gradient = np.zeros_like(weights)
        for r in seen.mapInArrow(gradients, counts.COLUMNS).toLocalIterator():
            found = np.frombuffer(r["counts"], dtype="<f4").reshape(-1, classes)
            first = 1 + states + r["chunk"] * block if r["chunk"] >= 0 else 0
            gradient[first : first + len(found)] += found
        shared.unpersist()
        gradient /= size
        past += gradient * gradient
        weights = weights - np.float32(0.3) * gradient / (np.sqrt(past) + np.float32(1e-9))
    logs = np.empty((len(rows), classes), dtype=np.float32)
    for at in range(0, len(rows), states):
        logs[at : at + states] = _log_softmax(weights, rows[at : at + states])
    return logs


class Requests:
    """The distinct pairs of a slice as it asks for them: by bucket, then by the first word.

    ``pair`` is each token's pair. ``first`` and ``second`` are the pairs' words; pairs of one first word and bucket
    make a run, ``runs`` are the starts of runs, and ``cuts`` those of buckets.
    """

    def __init__(self, part: Slice, classes: Classes, buckets: int):
        pairs, at = np.unique(part.before.astype(np.int64) * len(part.hashes) + part.token, return_inverse=True)
        first, second = np.divmod(pairs, len(part.hashes))
        ahead, behind = part.hashes[first], part.hashes[second]
        by_pair = (classes.common(part.hashes) >= 0)[first]
        bucket = grams.mixed(np.where(by_pair, _of_pair(ahead, behind), ahead)) % np.uint64(buckets)
        order = np.argsort(bucket.astype(np.int32), kind="stable")
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        self.pair, self.first, self.second = place[at], first[order], second[order]
        bucket = bucket[order].astype(np.int64)
        self.cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        self.buckets = bucket[self.cuts]
        self.runs = np.flatnonzero((np.diff(self.first, prepend=-1) != 0) | (np.diff(bucket, prepend=-1) != 0))


def _of_pair(ahead: np.ndarray, behind: np.ndarray) -> np.ndarray:
    return grams.mixed(ahead * grams.BASES[0] + behind)


def _requests(slices: DataFrame, classes, buckets: int) -> DataFrame:
    """(bucket, slice, ahead, runs, behind, times): the pairs of a slice that ask in a bucket, and how often they occur in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, part in zip(batch.column("slice").to_pylist(), Slice.read(batch)):
                asked = Requests(part, classes.value, buckets)
                times = np.bincount(asked.pair[part.trains], minlength=len(asked.first))
                packs = []
                for a, b in zip(asked.cuts, np.append(asked.cuts[1:], len(asked.first))):
                    runs = asked.runs[np.searchsorted(asked.runs, a) : np.searchsorted(asked.runs, b)]
                    ahead, behind = part.hashes[asked.first[runs]], part.hashes[asked.second[a:b]]
                    packs.append((ahead.tobytes(), _squeezed(np.diff(np.append(runs, b))), behind.tobytes(), _squeezed(times[a:b])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(asked.buckets.astype(np.int32)),
                        pa.array(np.full(len(packs), number)),
                        *[pa.array(column, type=pa.binary()) for column in zip(*packs)],
                    ],
                    names=["bucket", "slice", "ahead", "runs", "behind", "times"],
                )

    return slices.mapInArrow(run, "bucket int, slice bigint, ahead binary, runs binary, behind binary, times binary")


def _answers(requests: DataFrame, classes) -> DataFrame:
    """(slice, bucket, c2, n1, d1): for each request its pairs' training counts, and what followed the first word of each run, and how many.

    The commonest words ask in all buckets: how many tokens followed them is also counted by bucket, with no slice.
    """

    def answered(asked: pa.Table) -> pa.Table:
        bucket, numbers = asked.column("bucket")[0].as_py(), asked.column("slice").to_pylist()
        ahead = [np.frombuffer(x, dtype="<u8") for x in asked.column("ahead").to_pylist()]
        runs = [_loosened(x) for x in asked.column("runs").to_pylist()]
        first = np.concatenate([np.repeat(a, r) for a, r in zip(ahead, runs)])
        pairs = _of_pair(first, np.concatenate([np.frombuffer(x, dtype="<u8") for x in asked.column("behind").to_pylist()]))
        order = np.argsort(pairs)
        pairs = pairs[order]
        starts = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        del pairs
        sums = np.add.reduceat(np.concatenate([_loosened(x) for x in asked.column("times").to_pylist()])[order], starts)
        first = first[order[starts]]
        c2 = np.empty(len(order), dtype=np.int64)
        c2[order] = np.repeat(sums, np.diff(np.append(starts, len(order))))
        del order
        words, of_word = np.unique(first, return_inverse=True)
        n1 = np.bincount(of_word, sums).astype(np.int64)
        d1 = np.bincount(of_word, sums > 0).astype(np.int64)
        rows, at = [], 0
        for number, own, run in zip(numbers, ahead, runs):
            place, size = np.searchsorted(words, own), int(run.sum())
            rows.append((number, bucket, _squeezed(c2[at : at + size]), _squeezed(n1[place]), _squeezed(d1[place])))
            at += size
        common = classes.value.common(words)
        if (common >= 0).any():
            parts = np.zeros(len(classes.value.own) + 1, dtype=np.int64)
            parts[common[common >= 0]] = d1[common >= 0]
            rows.append((None, bucket, b"", b"", _squeezed(parts)))
        return pa.table(dict(zip(names, zip(*rows))), schema=schema)

    names = ["slice", "bucket", "c2", "n1", "d1"]
    schema = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])))
    return requests.groupBy("bucket").applyInArrow(answered, "slice bigint, bucket int, c2 binary, n1 binary, d1 binary")


def language_scores(
    docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text", remainder: int = 2, of: int = 7
) -> DataFrame:
    """One row per row of ``docs``: its id, held_out, n_tokens, n_known, train_tokens, base_score, score, class_score.

    Tokens are the words (runs of anything but ASCII white space, A-Z lower-cased) and
    one end. Texts whose id's crc32 leaves ``remainder`` are held out; a null id counts
    as empty text. ``base_score`` adds up log10((c + 1) / (N + V + 1)), c being the
    token's count in training, N and V the numbers of all and of distinct training
    tokens; ``class_score`` is the log10 probability of the maximum-entropy model, and
    ``score`` that of the interpolated bigram model.

    A null or empty text has the end token alone. Rows that repeat an id or a text
    count each. Without training texts all scores are those of no knowledge. No rows
    give no rows; other columns are ignored.
    """
    spark, number = docs.sparkSession, F.col(f"`{id_column}`").cast("bigint")
    source = docs.select(
        number.alias("id"), held_out(number, remainder, of).alias("held_out"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    slices = scratch.keep(_slices(source, SLICE_TOKENS).withColumn("slice", F.monotonically_increasing_id()), "slices")
    words = scratch.keep(_word_counts(slices), "words")
    total, distinct = words.agg(F.sum("c1"), F.count(F.lit(1))).first()
    total = int(total or 0)

    classes = word_classes(words, distinct)
    shared = spark.sparkContext.broadcast(classes)
    contexts = scratch.keep(_context_counts(slices, shared), "contexts")
    table = spark.sparkContext.broadcast(trained(contexts, classes.tokens))

    buckets = max(1, -(-(slices.agg(F.sum("tokens")).first()[0] or 0) // BUCKET_TOKENS))
    answers = scratch.keep(_answers(_requests(slices, shared, buckets), shared), "answers")
    after_common = np.zeros(len(classes.own) + 1, dtype=np.int64)
    for r in answers.where("slice IS NULL").select("d1").toLocalIterator():
        after_common += _loosened(r["d1"])

    def scored(own: pa.Table, found: pa.Table) -> pa.Table:
        model, logs, (part,) = shared.value, table.value, Slice.read(own)
        asked, texts, n_common = Requests(part, model, buckets), len(part.ends), len(model.own)
        c2, n1, d1 = (
            np.concatenate([_loosened(x) for x in found.sort_by("bucket").column(c).to_pylist()]).astype(np.float64) for c in ("c2", "n1", "d1")
        )
        n_after, kinds_after = np.zeros(len(part.hashes)), np.zeros(len(part.hashes))
        of_run = asked.first[asked.runs]
        n_after[of_run], kinds_after[of_run] = n1, d1
        common = model.common(part.hashes)
        whole = common >= 0
        n_after[whole] = np.append(model.tokens[:n_common], model.tokens[-1])[common[whole]]
        kinds_after[whole] = after_common[common[whole]]
        # Something follows each word, so that is how often it occurs; the end occurs once in each text.
        c1 = n_after.copy()
        c1[part.end] = model.tokens[-1]
        alone = (c1 + 1) / float(total + distinct + 1)
        n, kinds, p = n_after[asked.first], kinds_after[asked.first], alone[asked.second]
        mixed = np.where(n > 0, (c2 + kinds * p) / np.maximum(n + kinds, 1), p)

        context, followed = model.sequences(part)
        # What a word has of its class: all of it if the class is its own.
        in_class = np.log10(c1 + 1)
        in_class[part.end :] = 0
        of_words = model.of(part.hashes[: part.end])
        hashed = of_words >= model.size - 1 - model.hashed
        in_class[: part.end] = np.where(hashed, in_class[: part.end] - np.log10(model.tokens + model.words + 1)[of_words], 0)
        # One after the other: none of them is kept for all tokens.
        base = np.bincount(part.owner, np.log10(alone)[part.token], texts)
        bigrams = np.bincount(part.owner, np.log10(mixed)[asked.pair], texts)
        of_class = np.bincount(part.owner, logs[context, followed] / np.log(10) + in_class[part.token], texts)
        return pa.table(
            [
                own.column("id").combine_chunks().flatten(),
                own.column("held_out").combine_chunks().flatten(),
                pa.array(np.bincount(part.owner, minlength=texts)),
                pa.array(np.bincount(part.owner, c1[part.token] > 0, texts).astype(np.int64)),
                *[pa.array(x) for x in (base, bigrams, of_class)],
            ],
            names=["id", "held_out", "n_tokens", "n_known", "base_score", "score", "class_score"],
        )

    schema = "id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, class_score double"
    both = slices.groupBy("slice").cogroup(answers.where("slice IS NOT NULL").groupBy("slice"))
    return both.applyInArrow(scored, schema).select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        "class_score",
    )
