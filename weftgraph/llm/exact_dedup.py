"""Exact deduplication by full content, safe against hot groups of copies.

Three stages, all built-in functions:

1. every map task combines its own rows of equal (digest, content, salt), so a hot
   text leaves a task once per salt at most;
2. the salted groups are merged by (digest, content, salt);
3. the salts' winners are combined by (digest, content).

Content is part of the key of each stage, so different texts of one digest stay
apart. The rows then get their group by (digest, salt), with digest collisions told
apart by content. Salts come from the row id: a hot group's rows and its copies of
the group's row are spread over ``salts`` keys, and only salts that occur are copied.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.scratch import Scratch

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts of one byte per character take Spark's faster function, which then does the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER)
    )


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_dedup(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs``: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. Of
    equal texts the row with the largest id stays. Rows that repeat an id and a text
    are the same document: all of them carry ``kept``. A null id never wins against
    another id; where a group has no other, keep_id is null and ``kept`` is true. No
    rows give no rows; other columns are ignored.

    ``digest`` only deals rows out; any function of the text gives the same result.
    """
    keyed = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        ascii_lower(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))).alias("content"),
    ).select(
        "id",
        "content",
        digest(F.col("content")).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    )
    salted = keyed.groupBy("digest", "content", "salt").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
    groups = salted.groupBy("digest", "content").agg(
        F.max("best").alias("keep_id"), F.sum("n").alias("group_size"), F.collect_set("salt").alias("salts")
    )
    # From here on content is only carried where it is needed: a digest is listed with its
    # number of different contents, which is one unless the digest collides.
    by_digest = groups.groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"),
        F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.flatten(F.collect_list("salts")).alias("salts"),
    )
    listed = scratch.keep(by_digest, "digests")
    single = listed.where(F.col("contents") == 1).select(
        "digest", F.explode("salts").alias("salt"), "keep_id", "group_size"
    )
    narrow = keyed.select("id", "digest", "salt", sha256(F.col("content")).alias("text_sha256"))
    found = narrow.join(single, ["digest", "salt"]).select("id", "keep_id", "group_size", "text_sha256")
    colliding = listed.where(F.col("contents") > 1).select("digest")
    if not colliding.isEmpty():
        rows = keyed.join(colliding, "digest", "left_semi")
        own = groups.join(colliding, "digest", "left_semi").withColumn("salt", F.explode("salts"))
        found = found.unionByName(
            rows.join(own, ["digest", "content", "salt"]).select(
                "id", "keep_id", "group_size", sha256(F.col("content")).alias("text_sha256")
            )
        )
    return found.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
