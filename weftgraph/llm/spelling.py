"""Spelling variants: words at edit distance 1, by an index of grams of variable length.

1. A dictionary of grams of ``SHORTEST`` to ``LONGEST`` code points is built from the
   words. Grams of the least length always belong to it; a longer one does if the gram
   without its last code point is in many words (else that one is selective enough)
   and it is not rare itself (else it would only enlarge the dictionary).
2. A word, with a mark at either end, is cut into grams: at each place the longest gram
   of the dictionary that starts there, unless an earlier gram covers it.
3. For each word the number of its grams that one edit can affect at most is worked
   out from the dictionary: grams that the edit touches, and grams that are lost because
   a longer one could now start before the edit, or end behind it.
4. All other grams of a word are also grams of every near word, at the same place
   from the start (then all before them is the same as well) or from the end (then all
   behind them is). So of the grams in order of their frequency, a word need only be
   listed under as many as can be affected, and one more: two near words meet on the
   rarest gram they share. Lists are merged by a join on a gram with what is before or
   behind it, and pairs are verified by their edit distance inside the join.

Since the grams of a word cover all its neighbouring pairs of code points, and one edit
only affects grams within ``2 * LONGEST - 1`` code points, a word of ``2 * LONGEST - 2``
code points or more (two more with its marks) always keeps a gram. Shorter words are
refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest

from weftgraph.scratch import Scratch

SHORTEST, LONGEST = 2, 4
# Longer grams are rare below 1 / 2^16 of all places, and a gram is in many words above RARE times that.
# So the dictionary has at most 2^16 grams of each length above the least, whatever the number of words.
PLACES, RARE = 1 << 16, 16
START, END = "\u0002", "\u0003"


@dataclass(frozen=True)
class Dictionary:
    """Grams with their numbers of places, and what one can see at the edge of an edit: parts of longer grams."""

    frequency: Mapping[str, int]
    heads: frozenset[str]
    tails: frozenset[str]

    @staticmethod
    def of(frequency: Mapping[str, int]) -> Dictionary:
        longer = [g for g in frequency if len(g) > SHORTEST]
        return Dictionary(
            frequency,
            frozenset(g[:n] for g in longer for n in range(SHORTEST, len(g))),
            frozenset(g[-n:] for g in longer for n in range(SHORTEST, len(g))),
        )


def decomposed(word: str, known: Dictionary) -> list[tuple[int, int]]:
    """Start and end (exclusive) of the grams of a word with its marks."""
    found, covered = [], 0
    for start in range(len(word) - SHORTEST + 1):
        end = start + SHORTEST
        for size in range(LONGEST, SHORTEST, -1):
            # All shorter forms of a long gram are in the dictionary, too.
            if word[start : start + size] in known.frequency and start + size <= len(word):
                end = start + size
                break
        if end > covered:
            found.append((start, end))
            covered = end
    return found


def most_affected(word: str, grams: list[tuple[int, int]], known: Dictionary) -> int:
    """How many of a word's grams one insertion, deletion or replacement can affect at most."""
    size, most = len(word), 0
    for at in range(1, size):
        # A longer gram could start from here on and reach over the edit.
        first = at
        for start in range(max(0, at - LONGEST + 1), at - SHORTEST + 1):
            if word[start:at] in known.heads:
                first = start
                break
        # An insertion before ``at``, then a change of the code point at ``at`` (never that of a mark).
        for behind in (at, at + 1) if at < size - 1 else (at,):
            # A longer gram could start in or before the edit and reach to here.
            reach = behind
            for end in range(min(size, behind + LONGEST - 1), behind + SHORTEST - 1, -1):
                if word[behind:end] in known.tails:
                    reach = end
                    break
            hit = 0
            for start, end in grams:
                if end <= at:
                    hit += start >= first
                elif start >= behind:
                    hit += end <= reach
                else:
                    hit += 1
            most = max(most, hit)
    return most


def listed(word: str, known: Dictionary) -> list[int]:
    """The keys of the lists that a word is on, so that near words are on one together."""
    word = START + word + END
    grams = decomposed(word, known)
    ranked = sorted((known.frequency.get(word[s:e], 0), word[s:e], s, e) for s, e in grams)
    last = ranked[most_affected(word, grams, known)][:2]
    keys = []
    for frequency, gram, start, end in ranked:
        if (frequency, gram) > last:
            break
        # The same gram with the same text before it, or behind it.
        keys.append(xxh3_64_intdigest(f"{start}:{word[:end]}"))
        keys.append(xxh3_64_intdigest(f"{word[start:]}:{len(word) - end}"))
    return keys


def gram_dictionary(words: DataFrame, scratch: Scratch) -> Dictionary:
    """The frequency-pruned gram dictionary of distinct words (column word)."""
    marked = words.select(F.concat(F.lit(START), "word", F.lit(END)).alias("word"))

    def cut(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.char_length("word") - (size - 1))
        some = F.transform(starts, lambda i: F.substring(F.col("word"), i, F.lit(size)))
        return F.when(F.char_length("word") >= size, some).otherwise(F.array().cast("array<string>"))

    all_grams = F.concat(*[cut(size) for size in range(SHORTEST, LONGEST + 1)])
    counts = marked.select(F.explode(all_grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("places"))
    counts = scratch.keep(counts, "grams")
    total = counts.where(F.char_length("gram") == SHORTEST).agg(F.sum("places")).first()[0] or 0
    rare = -(-total // PLACES)
    common = counts.where(F.col("places") >= rare)
    stems = counts.where(F.col("places") > rare * RARE).select(F.col("gram").alias("stem"))
    is_short = F.char_length("gram") == SHORTEST
    longer = common.where(~is_short).withColumn("stem", F.expr("left(gram, char_length(gram) - 1)")).join(stems, "stem")
    kept = common.where(is_short).unionByName(longer.drop("stem"))
    return Dictionary.of({r["gram"]: r["places"] for r in kept.toLocalIterator()})


def near_words(words: DataFrame, known: Dictionary) -> DataFrame:
    """All pairs of distinct words that differ by one edit, in both directions: word, n, near, near_n."""
    shared = words.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [listed(w, shared.value) for w in batch.column(0).to_pylist()]
            at = [i for i, found in enumerate(keys) for _ in found]
            flat = pa.array([k - (1 << 64) if k >> 63 else k for found in keys for k in found], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at, type=pa.int64())).columns, flat], names=["word", "n", "key"])

    lists = words.select("word", "n").mapInArrow(run, "word string, n bigint, key bigint")
    # One edit changes the set of a word's letters by two at most.
    letters = F.aggregate(
        F.split("word", ""),
        F.lit(0).cast("bigint"),
        lambda bits, c: bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.ascii(c), F.lit(64)))),
    )
    lists = lists.withColumn("size", F.char_length("word")).withColumn("letters", letters)
    one, other = (lists.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("word", "n", "size", "letters")]) for side in "ab")
    close = (
        (F.col("word_a") < F.col("word_b"))
        & (F.abs(F.col("size_a") - F.col("size_b")) <= 1)
        & (F.bit_count(F.col("letters_a").bitwiseXOR(F.col("letters_b"))) <= 2)
        & (F.levenshtein("word_a", "word_b", 1) == 1)
    )
    # Words become lists of many rows, which Spark does not count: it would take the lists for small enough to broadcast.
    pairs = one.join(other.hint("merge"), "key").where(close).select("word_a", "n_a", "word_b", "n_b").distinct()
    both = [
        pairs.select(
            F.col(f"word_{x}").alias("word"), F.col(f"n_{x}").alias("n"), F.col(f"word_{y}").alias("near"), F.col(f"n_{y}").alias("near_n")
        )
        for x, y in ("ab", "ba")
    ]
    return both[0].unionByName(both[1])


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """The last word that each word comes to by its form, by doubling: word, root. ``forms`` has word and form, never in a circle."""
    way = scratch.keep(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = scratch.keep(way.join(on.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "ways")
        way = further.drop("next")
        if further.where("next IS NOT NULL").isEmpty():
            return way


def spelling_variants(words: DataFrame, scratch: Scratch, ratio: int = 5) -> DataFrame:
    """One row per row of ``words`` (word, n): word, form, root, n, n_near, form_n.

    Two words are near if they differ by exactly one inserted, deleted or replaced code
    point. A word's form is its near word of largest n (of equal n the least in the
    order of code points) if that n is ``ratio`` times the word's n at least, else
    null; ``root`` is what following forms comes to, the word itself if it has none.
    ``n_near`` counts near words and ``form_n`` is the form's n.

    Words must be distinct and have 2 * LONGEST - 2 code points at least, and ``ratio`` must be
    above 1, so that forms never lead in a circle. Null words are left out; a null n
    counts as 0, and such a word is nobody's form. No rows give no rows; other columns
    are ignored.
    """
    if ratio < 2:
        raise ValueError(f"ratio must be above 1, not {ratio}")
    chosen = words.where(F.col("word").isNotNull()).select("word", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    kept = scratch.keep(chosen, "words")
    if not kept.where(F.char_length("word") < 2 * LONGEST - 2).isEmpty():
        raise ValueError(f"words must have {2 * LONGEST - 2} code points at least")
    near = near_words(kept, gram_dictionary(kept, scratch))
    best = near.groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("back"), "near")).alias("best")
    )
    best = scratch.keep(best, "best")
    enough = (-F.col("best.back") >= F.col("n") * ratio) & (F.col("best.back") < 0)
    forms = best.select(
        "word", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.back")).alias("form_n")
    )
    ways = roots(forms.where("form IS NOT NULL"), scratch)
    # Compressed words take several times their files' size in memory, so none of these tables is broadcast either.
    found = kept.join(forms.hint("merge"), "word", "left").join(ways.hint("merge"), "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def letter_runs(text: Column, least: int) -> Column:
    """Maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of ``least`` code points or more, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(text, upper, lower), F.lit("[a-zÀ-ÿ]{%d,}" % least), F.lit(0))


def damaged(owner: Column, run: Column, one_in: int) -> Column:
    """``run`` with one code point deleted where ``one_in`` divides the crc32 of ``<owner>:<run>``; unchanged if the owner is null."""
    sign = F.crc32(F.concat(owner.cast("string"), F.lit(":"), run).cast("binary"))
    at = (sign % F.char_length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(sign % one_in == 0, rest).otherwise(run)


def word_counts(
    docs: DataFrame, least: int = 6, least_count: int = 5, damage: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Letter runs of ``least`` code points or more that occur ``least_count`` times or more in whole texts: word, n.

    With ``damage`` one run in so many has a code point deleted first. Null and empty
    texts have no runs.
    """
    runs = docs.select(
        F.col(f"`{id_column}`").alias("owner"), F.explode(letter_runs(F.col(f"`{text_column}`").cast("string"), least)).alias("run")
    )
    word = damaged(F.col("owner"), F.col("run"), damage) if damage else F.col("run")
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= least).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
