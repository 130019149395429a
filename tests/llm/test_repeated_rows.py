"""Thousands of rows of one id cost as much as so many documents, and give what brute force gives."""

from __future__ import annotations

import random
import time

import pytest

import brute
from weftgraph.llm.substring_dedup import substring_dedup
from weftgraph.llm.suffix_dedup import suffix_dedup
from weftgraph.scratch import Scratch

COPIES = 5000


def words(seed, count):
    pick = random.Random(seed)
    return [f"{pick.choice('bcdfg')}{pick.choice('aeiou')}{pick.randrange(10_000)}" for _ in range(count)]


def removed_words(docs, width=13):
    """(id, words, removed) by windows that start in a document with a smaller id; rows of one id are one document."""
    least = {}
    for number, text in docs:
        own = (text or "").split()
        for i in range(len(own) - width + 1):
            window = tuple(own[i : i + width])
            least[window] = min(number, least.get(window, number))
    gone = {}
    for number, text in docs:
        own = (text or "").split()
        for i in range(len(own) - width + 1):
            if least[tuple(own[i : i + width])] < number:
                gone.setdefault(number, set()).update(range(i, i + width))
    rows = []
    for number, text in docs:
        size = len((text or "").split())
        rows.append((number, size, sum(1 for p in gone.get(number, ()) if p < size)))
    return sorted(rows)


@pytest.fixture(scope="module")
def warm(spark):
    """The first query of a session pays for starting workers."""
    frame = spark.createDataFrame([(1, "a b"), (2, "a b")], "doc_id bigint, text string")
    substring_dedup(frame, Scratch(spark)).collect()
    suffix_dedup(frame, Scratch(spark)).collect()


def test_substring_dedup_of_many_rows_of_one_id(spark, warm):
    shared, own = words(1, 300), words(2, 60)
    text = " ".join(own[:20] + shared + own[20:])
    docs = [(3, " ".join(words(3, 40) + shared[:200] + words(4, 10)))] + [(7, text)] * COPIES
    docs += [(7, " ".join(words(5, 15) + shared[50:90])), (9, " ".join(shared[150:] + own)), (10, "short")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)
    started = time.monotonic()
    found = substring_dedup(frame, Scratch(spark)).select("doc_id", "n_words", "n_removed").collect()
    assert time.monotonic() - started < 120
    assert sorted(map(tuple, found)) == removed_words(docs)


@pytest.mark.parametrize("number", [7, None])
def test_suffix_dedup_of_many_rows_of_one_id(spark, warm, number):
    shared = " ".join(words(1, 150))
    text = " ".join(words(2, 30)) + shared + " ".join(words(3, 40))
    docs = [(number, text)] * COPIES + [(number, "other " + shared[100:800]), (9, shared[300:]), (9, "short")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(8)
    started = time.monotonic()
    found = suffix_dedup(frame, Scratch(spark), as_digest=True).collect()
    assert time.monotonic() - started < 120
    # Two copies stand for all: each is elsewhere as well.
    few = docs[:2] + docs[COPIES:]
    want = brute.bytes_removed([t for _, t in few], 400)
    want = [(*d, *w) for d, w in zip(few, want)]
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept"]) for r in found}
    assert got == {(n, *w) for n, _, *w in want}
    assert len(found) == len(docs)
