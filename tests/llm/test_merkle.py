"""The Merkle manifest against a plain version, and the cases its docstring names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import brute
from weftgraph.llm import merkle
from weftgraph.scratch import Scratch

COLUMNS = ["doc_id", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, lang string, n_chars bigint, text string, place int, tree string"


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    changed = {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    made = merkle.manifest(frame, Scratch(spark), COLUMNS, changed=changed, **options)
    proofs = merkle.sha256(merkle.siblings(F.col("path")))
    folded = merkle.folded(F.col("changed_leaf"), F.col("path"))
    return [tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", proofs, folded).collect()]


def wanted(rows):
    def changed(row):
        more = row["n_chars"] is not None and row["doc_id"] is not None and row["doc_id"] % 3 == 0
        return {**row, "n_chars": row["n_chars"] + more if row["n_chars"] is not None else None}

    return brute.merkle_rows([dict(zip(COLUMNS, r)) for r in rows], COLUMNS, changed)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r))


@pytest.mark.parametrize("sizes", [(1,), (2,), (1, 1, 1), (5, 1, 8), (33, 7, 2)])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(100 * g + i, f"l{g}", i if i % 4 else None, f"text {i} " * (i % 5)) for g, n in enumerate(sizes) for i in range(n)]
    assert order(found(spark, rows)) == order(wanted(rows))


def test_several_passes_over_a_tree(spark, monkeypatch):
    # With blocks of four nodes a tree of 70 leaves takes four passes.
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "ROWS_PER_RANGE", 10)
    rows = [(i, None if i % 9 == 0 else "ab"[i % 2], i, f"t{i}") for i in range(150)]
    assert order(found(spark, rows)) == order(wanted(rows))


def test_awkward_rows(spark):
    rows = [
        (None, "a", 1, "no id"),
        (None, "a", 1, "no id"),
        (3, "a", None, None),
        (3, "a", 4, ""),
        (3, "a", 4, ""),
        (4, None, 5, "-"),
        (5, "", 6, "null group, then the group without a name"),
        (6, "é", 7, "ß" * 3),
        (7, "z", 8, "x" * 100_000),
        (7, "=", 8, "x"),
    ]
    assert order(found(spark, rows)) == order(wanted(rows))


def test_no_rows(spark):
    assert found(spark, []) == []


def test_only_changed_rows_fail(spark):
    rows = [(i, "ab"[i % 2], i, "t") for i in range(20)]
    assert {r[0] for r in found(spark, rows) if r[5] != r[3]} == {i for i in range(20) if i % 3 == 0}
