"""Spelling variants against brute force: gram bounds, pairs, forms and roots."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import brute
from weftgraph.llm import spelling
from weftgraph.scratch import Scratch

WORD = st.text("abc", min_size=6, max_size=10)
# Any set of grams of which every head belongs to it.
GRAMS = st.sets(st.text("abc" + spelling.START + spelling.END, min_size=3, max_size=4), max_size=60)


def dictionary(grams):
    closed = sorted({g[:3] for g in grams} | grams)
    return spelling.Dictionary.of({g: i % 7 for i, g in enumerate(closed)})


def edits(word):
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in "abcd")
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in "abcd" if c != word[i])


@settings(max_examples=60, deadline=None)
@given(WORD, GRAMS)
def test_near_words_are_on_a_list_together(word, grams):
    known = dictionary(grams)
    own = set(spelling.listed(word, known))
    for other in edits(word):
        if len(other) >= 6:
            assert own & set(spelling.listed(other, known)), other


@settings(max_examples=60, deadline=None)
@given(WORD, GRAMS)
def test_bound_of_affected_grams(word, grams):
    known = dictionary(grams)

    def cut(w):
        marked = spelling.START + w + spelling.END
        return Counter(marked[s:e] for s, e in spelling.decomposed(marked, known))

    marked = spelling.START + word + spelling.END
    bound = spelling.most_affected(marked, spelling.decomposed(marked, known), known)
    assert bound < sum(cut(word).values())
    for other in edits(word):
        assert sum((cut(word) - cut(other)).values()) <= bound


def test_dictionary_is_pruned(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RARE", 4)
    monkeypatch.setattr(spelling, "PLACES", 100)
    words = [f"{a}{b}{c}stone" for a in "bcdf" for b in "aeiou" for c in "klmn"]
    known = spelling.gram_dictionary(spark.createDataFrame([(w,) for w in words], "word string"), Scratch(spark))
    places = Counter()
    for w in words:
        w = spelling.START + w + spelling.END
        places.update(w[i : i + q] for q in (2, 3, 4) for i in range(len(w) - q + 1))
    rare = -(-sum(n for g, n in places.items() if len(g) == 2) // 100)
    want = {g: n for g, n in places.items() if n >= rare and (len(g) == 2 or places[g[:-1]] > 4 * rare)}
    assert known.frequency == want and 0 < len(want) < len(places)


def by_word(frame):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in frame.collect()}


@pytest.mark.parametrize("rare", [1, 16])
def test_variants_agree_with_brute_force(spark, monkeypatch, rare):
    monkeypatch.setattr(spelling, "RARE", rare)
    pick = random.Random(rare)
    words = {}
    for _ in range(60):
        word = "".join(pick.choice("aeéxß") for _ in range(pick.randint(6, 9)))
        words[word] = pick.randint(1, 2000)
        for other in pick.sample(list(edits(word)), 4):
            if len(other) >= 6:
                words.setdefault(other, pick.choice([1, 2, 3, 40, 200, 200]))
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = by_word(spelling.spelling_variants(frame, Scratch(spark)))
    assert found == brute.variants(words)
    assert any(form is not None and form != root for form, root, *_ in found.values())


def test_ties_chains_and_awkward_rows(spark):
    words = {"abcdef": 500, "abcdeg": 500, "abcdex": 100, "abcdexx": 10, "abcdexxx": 2, "zzzzzz": 1, "ábcdef": 1}
    rows = [(w, n, "k", 0) for w, n in words.items()] + [(None, 7, "k", 0)]
    frame = spark.createDataFrame(rows, "word string, n bigint, key string, letters int")
    found = by_word(spelling.spelling_variants(frame, Scratch(spark)))
    assert found == brute.variants(words)
    assert found["abcdexxx"][:2] == ("abcdexx", "abcdef") and found["abcdex"][0] == "abcdef"


def test_no_words_and_refused_input(spark):
    schema = "word string, n bigint"
    assert by_word(spelling.spelling_variants(spark.createDataFrame([], schema), Scratch(spark))) == {}
    null_n = spark.createDataFrame([("abcdef", None), ("abcdeg", None)], schema)
    assert by_word(spelling.spelling_variants(null_n, Scratch(spark))) == {w: (None, w, 0, 1, None) for w in ("abcdef", "abcdeg")}
    with pytest.raises(ValueError, match="code points"):
        spelling.spelling_variants(spark.createDataFrame([("short", 1)], schema), Scratch(spark))
    with pytest.raises(ValueError, match="ratio"):
        spelling.spelling_variants(spark.createDataFrame([], schema), Scratch(spark), ratio=1)


def test_word_counts(spark):
    texts = [(1, "Letters, LETTERS; lettersÉ x"), (2, None), (None, "letters"), (3, ""), (4, "word " * 50_000 + "letters")]
    frame = spark.createDataFrame([(*t, "w") for t in texts], "doc_id bigint, text string, word string")
    counts = {r["word"]: r["n"] for r in spelling.word_counts(frame, least_count=1).collect()}
    assert counts == {"letters": 4, "lettersÉ": 1}
    # Every run is damaged once per (owner, run); a null owner's never is.
    damaged = {r["word"]: r["n"] for r in spelling.word_counts(frame, least_count=1, damage=1).collect()}
    assert damaged["letters"] >= 1 and sum(damaged.values()) == 5 and all(len(w) >= 6 for w in damaged)


def test_damage_by_crc(spark):
    import zlib

    rows = [(i, "abcdéfgh") for i in range(40)]
    frame = spark.createDataFrame(rows, "id bigint, run string")
    got = [r[0] for r in frame.orderBy("id").select(spelling.damaged(F.col("id"), F.col("run"), 3)).collect()]
    want = []
    for i, run in rows:
        h = zlib.crc32(f"{i}:{run}".encode())
        want.append(run[: h % len(run)] + run[h % len(run) + 1 :] if h % 3 == 0 else run)
    assert got == want
