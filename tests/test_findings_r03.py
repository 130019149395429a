"""Cases that the findings of round 3 showed to be wrong before."""

from __future__ import annotations

from weftgraph.plans import table_queries


def test_text_keys_that_repeat_are_all_numbered(spark):
    rows = [(3, "b", "x"), (1, "a", "x"), (2, "b", "x"), (4, None, "x"), (5, "a", "x")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").createOrReplaceTempView("pages")
    found = table_queries.vertex_index_text_key(spark, None)
    assert sorted((tuple(r) for r in found.select("url", "page", "vid").collect()), key=lambda r: r[2]) == [
        ("a", 1, 0),
        ("a", 5, 1),
        ("b", 2, 2),
        ("b", 3, 3),
        (None, 4, 4),
    ]


def test_language_model_scores_every_word_pair_of_the_corpus(spark):
    import math
    import zlib

    from weftgraph.llm.language_model import language_scores
    from weftgraph.scratch import Scratch

    training = lambda d: zlib.crc32(str(d).encode()) % 7 != 2
    texts = {1: "a b c", 3: "A b d", 4: "c a", 5: "b c e f"}
    held = next(d for d in range(100, 200) if not training(d))
    texts[held] = "a b c d"
    rows = [(d, t) for d, t in texts.items()]
    found = {r["doc_id"]: r for r in language_scores(spark.createDataFrame(rows, "doc_id bigint, text string"), Scratch(spark)).collect()}
    said = [t.lower().split() + [None] for d, t in rows if training(d)]
    pairs = [(([None] + s)[i], w) for s in said for i, w in enumerate(s)]
    ones = [w for _, w in pairs]
    whole = len(ones) + len(set(ones)) + 1
    alone = lambda w: (ones.count(w) + 1) / whole

    def odds(u, w):
        after = [b for a, b in pairs if a == u]
        if not after:
            return alone(w)
        return (after.count(w) + len(set(after)) * alone(w)) / (len(after) + len(set(after)))

    for d, t in rows:
        own = t.lower().split() + [None]
        want = sum(math.log10(odds(u, w)) for u, w in zip([None] + own, own))
        assert math.isclose(found[d]["score"], want, rel_tol=1e-9), d
        assert math.isclose(found[d]["base_score"], sum(math.log10(alone(w)) for w in own), rel_tol=1e-9)
    assert found[held]["score"] > found[held]["base_score"]


def test_small_ranges_share_partitions_and_keep_positions(spark):
    from weftgraph.operators.adjacency import adjacency, arranged
    from weftgraph.operators.ranking import numbered
    from weftgraph.scratch import Scratch

    rows = [(s % 7, (s * 5) % 11, s) for s in range(100)]
    edges = spark.createDataFrame(rows, "src_vid bigint, dst_vid bigint, edge_row bigint")
    laid = arranged(edges, "source", 4, 100, rows_per_range=8)
    # No more tasks than shuffle partitions (8) for the 13 ranges of 8 rows, not one for each.
    assert laid.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) < 13
    assert sum(r["count"] for r in laid.groupBy("range").count().collect()) == 100
    with Scratch(spark) as scratch:
        found = adjacency(edges, "source", scratch, 4, 10, rows_per_range=8)
        want = sorted((s, d) for s, d, _ in rows)
        got = sorted((r["src_vid"], r["dst_vid"], r["vertex_chunk"], r["pos"]) for r in found.collect())
        # Positions count the edges of each vertex chunk from 0, in order of (src_vid, dst_vid).
        assert [(s, d) for s, d, _, _ in got] == want
        for chunk in {c for _, _, c, _ in got}:
            assert [p for _, _, c, p in got if c == chunk] == list(range(sum(1 for *_, c, _ in got if c == chunk)))
        placed = numbered(edges, ["src_vid", "dst_vid", "edge_row"], "n", scratch, rows_per_range=8)
        assert sorted(r["n"] for r in placed.collect()) == list(range(100))
        in_order = sorted(placed.collect(), key=lambda r: r["n"])
        assert [(r["src_vid"], r["dst_vid"], r["edge_row"]) for r in in_order] == sorted(rows)
