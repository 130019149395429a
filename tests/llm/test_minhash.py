"""Circulant MinHash against brute force, and the cases its docstring names."""

from __future__ import annotations

import random

import numpy as np
import pytest

import brute
from weftgraph.llm import minhash, queries
from weftgraph.scratch import Scratch


def near(spark, docs, schema="doc_id bigint, text string", **options):
    frame = spark.createDataFrame(docs, schema)
    return [tuple(r) for r in minhash.near_duplicates(frame, Scratch(spark), **options).collect()]


def test_coordinates_agree_as_often_as_sets_do():
    pick = np.random.default_rng(5)
    for shared, own in ((300, 100), (60, 15), (4, 1)):
        tokens = pick.integers(0, 1 << 63, shared + 2 * own, dtype=np.uint64)
        one, other = np.sort(tokens[: shared + own]), np.sort(np.concatenate([tokens[:shared], tokens[shared + own :]]))
        agree = minhash.signature(one, 2000) == minhash.signature(other, 2000)
        assert abs(agree.mean() - shared / (shared + 2 * own)) < 0.06


def test_a_signature_is_one_permutation_turned():
    tokens = np.array([5 << 44, 900_000 << 44, (1 << 64) - 1], dtype=np.uint64)
    first, _ = minhash._tables(minhash.CIRCLE_BITS, 160)
    _, values = minhash._tables(minhash.CIRCLE_BITS, 160)
    second = values[:, 0]
    points = first[(tokens >> np.uint64(44)).astype(int)].astype(int)
    for k in (0, 1, 77, 159):
        assert minhash.signature(tokens, 160)[k] == second[(points + k) % (1 << 20)].min()


def test_query_agrees_with_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = queries.op13_minhash_dedup(spark, folder).collect()
    want = brute.linked_components(rows, percent=80, size=2)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def varied(seed, copies, words, changes):
    pick = random.Random(seed)
    base = [f"w{pick.randrange(500)}" for _ in range(words)]
    texts = []
    for _ in range(copies):
        own = list(base)
        for _ in range(pick.randint(0, changes)):
            own[pick.randrange(words)] = f"x{pick.randrange(10_000)}"
        texts.append(" ".join(own))
    return texts


def test_large_group_of_near_copies_in_small_blocks(spark, monkeypatch):
    # Groups in which many are linked to others only, over several blocks, tasks of a band and large sets.
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "LARGE", 120)
    monkeypatch.setattr(minhash, "ROWS_AT_ONCE", 20)
    texts = varied(1, 150, 100, 14) + varied(2, 60, 200, 30) + varied(3, 40, 12, 2) + [f"a b c {i}" for i in range(30)]
    rows = list(enumerate(texts, start=1000))
    want = brute.linked_components(rows, percent=80, size=2)
    assert {d: (n, c) for d, n, c, _ in near(spark, rows)} == want
    assert 5 < len({c for _, c in want.values()}) < len(rows)


def test_awkward_rows(spark):
    schema = "doc_id bigint, text string, class string, no bigint, key string"
    long_text = " ".join(f"v{i}" for i in range(30_000))
    texts = [
        (9, "The same text HERE"),
        (2, "the SAME text here"),
        (5, None),
        (6, ""),
        (6, " \t\n"),
        (7, "word"),
        (8, "WORD"),
        (3, "an id of two texts"),
        (3, long_text),
        (1, long_text + " more"),
        (None, "the same text here"),
        (None, None),
        (4, "another"),
        (4, ""),
        (4, "another"),
    ]
    found = near(spark, [(*t, "a", 1, "b") for t in texts], schema)
    assert sorted(f for f in found if f[0] is not None) == sorted(
        [
            (9, 3, 2, False),
            (2, 3, 2, True),
            (5, 0, 5, True),
            (6, 0, 6, True),
            (6, 0, 6, True),
            (7, 1, 7, True),
            (8, 1, 7, False),
            (3, 4, 1, False),
            (3, 29_999, 1, False),
            (1, 30_000, 1, True),
            (4, 1, 4, True),
            (4, 0, 4, True),
            (4, 1, 4, True),
        ]
    )
    assert sorted(f[1:] for f in found if f[0] is None) == [(0, None, True), (3, None, True)]


def test_many_rows_of_one_id_and_text(spark):
    found = near(spark, [(1, "one text of some words")] * 3000 + [(2, "one text of some words")])
    assert found.count((1, 4, 1, True)) == 3000 and (2, 4, 1, False) in found


def test_no_rows_and_refused_settings(spark):
    assert near(spark, []) == []
    with pytest.raises(ValueError, match="bands"):
        near(spark, [], percent=70)


def test_lower_thresholds_take_other_bands(spark):
    texts = [(i, t) for i, t in enumerate(varied(7, 40, 60, 14))]
    want = brute.linked_components(texts, percent=60, size=2)
    assert {d: (n, c) for d, n, c, _ in near(spark, texts, percent=60, bands=60, rows=3)} == want
