"""A Merkle tree over a table, one subtree per group, with a proof per row by pointer jumping.

Rows become leaves, ordered within their group. Every ``ARITY`` consecutive nodes
become one node of the next level until one is left, the group's subroot; subroots
in the order of their groups become the root in the same way.

A node's first segment is one step: the sibling it is hashed with. Segments then grow
by repeated self-joins: the segment of a node to the ancestor ``d`` levels up, joined to
that ancestor's own segment, gives the segment over ``2 * d`` levels. Of the segments
over ``d`` levels only those that start at a multiple of ``d`` are ever joined again, so
a round joins all leaves to 1/2^d of the nodes. After log2(height) rounds every leaf
holds its siblings up to its subroot, and every subroot its own up to the root.

All work is done by built-in functions. Nodes are made from blocks of at most
``2 ** LEVELS`` consecutive ones, ``LEVELS`` levels at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from weftgraph.operators.ranking import numbered
from weftgraph.scratch import Scratch

ARITY = 2
# Levels made from one block of nodes in one task.
LEVELS = 10
# Leaves are sorted in ranges of so many rows, or in so many ranges if there are more.
ROWS_PER_RANGE, RANGES = 1 << 15, 1 << 12
# Small tables of upper nodes are written in files of so many rows.
ROWS_PER_FILE = 1 << 14
# The first byte of a step: on which side its sibling stands.
LEFT, RIGHT = "00", "01"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else the number of its UTF-8 bytes, ``:`` and its text."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), text))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_hash(values: list[Column]) -> Column:
    """Lower-case hex digest of a row's values."""
    return sha256(F.concat(*[field(v) for v in values]))


def combined(digests: Column) -> Column:
    """The digest of several digests as hex text, laid end to end."""
    return sha256(F.array_join(digests, ""))


@dataclass(frozen=True)
class Forest:
    """Nodes of some trees and how their leaves were numbered.

    ``leaves``: the given columns with ``tree``, ``place`` (0-based within the tree), ``leaf``.
    ``nodes``: tree, level, place, step (the sibling with its side, empty if there is none).
    ``roots``: tree, subroot, size (number of leaves). ``height`` is that of the highest tree.
    """

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    height: int
    rows: int


def forest(leaves: DataFrame, order: list[str], scratch: Scratch) -> Forest:
    """Trees over rows with ``tree`` and ``leaf`` (hex digest), each in the order of ``order``."""
    rows = leaves.count()
    # Rows equal in ``order`` are cut apart by their leaves; with equal leaves they are interchangeable.
    per_range = max(ROWS_PER_RANGE, -(-rows // RANGES))
    placed = numbered(leaves, ["tree", *order, "leaf"], "place", scratch, within="tree", total=rows, rows_per_range=per_range)
    placed = scratch.keep(placed, "leaves")
    sizes = scratch.keep(placed.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "sizes")
    top = sizes.agg(F.max("size")).first()[0] or 0
    height = max(0, top - 1).bit_length()
    level = placed.join(sizes, "tree").select("tree", "place", F.col("leaf").alias("digest"), "size")
    steps, roots = [], []
    for base in range(0, max(height, 1), LEVELS):
        blocks = scratch.keep(_blocks(level, base), "blocks")
        steps.append(blocks.select("tree", F.inline("steps")))
        tops = blocks.select("tree", F.col("block").alias("place"), "digest", F.col("left").alias("size"), "leaves")
        roots.append(tops.where("size = 1").select("tree", F.col("digest").alias("subroot"), F.col("leaves").alias("size")))
        level = tops.where("size > 1")
    nodes, found = steps[0], roots[0]
    for more in steps[1:]:
        nodes = nodes.unionByName(more)
    for more in roots[1:]:
        found = found.unionByName(more)
    return Forest(placed, nodes, scratch.keep(found, "roots"), height, rows)


def _blocks(level: DataFrame, base: int) -> DataFrame:
    """One row per block of nodes of level ``base``: the steps of its nodes, the digest they come to, and how many blocks their tree has.

    A tree's last block goes up as far as the others do, so that each level's odd node is hashed alone.
    """
    if "leaves" not in level.columns:
        level = level.withColumn("leaves", F.col("size"))
    blocks = level.groupBy("tree", F.shiftright("place", LEVELS).alias("block"), "size", "leaves").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda n: n["digest"]).alias("at0")
    )
    columns, left = [], F.col("size")
    for up in range(LEVELS):
        # The nodes of this level in the whole tree: where one is left, it is the subroot and has no step.
        alone = left == 1
        blocks = blocks.withColumn(f"at{up + 1}", F.when(alone, F.col(f"at{up}")).otherwise(_parents(f"at{up}")))
        steps = _steps(f"at{up}", F.lit(base + up), F.shiftleft("block", LEVELS - up))
        columns.append(F.when(~alone, steps).otherwise(F.array().cast("array<struct<level:int,place:bigint,step:binary>>")))
        left = F.shiftright(left + 1, 1)
    return blocks.select(
        "tree",
        "block",
        F.flatten(F.array(*columns)).alias("steps"),
        F.element_at(f"at{LEVELS}", 1).alias("digest"),
        left.alias("left"),
        "leaves",
    )


def _parents(name: str) -> Column:
    """The digests of the level above an array of them."""
    digests = F.col(name)
    runs = F.sequence(F.lit(0), F.shiftright(F.size(digests) - 1, 1))
    return F.transform(runs, lambda i: combined(F.slice(digests, i * ARITY + 1, ARITY)))


def _steps(name: str, level: Column, first: Column) -> Column:
    """For each of an array of digests, the first of which stands at place ``first``, its sibling with its side."""
    digests = F.col(name)

    def step(_: Column, i: Column) -> Column:
        even = i % ARITY == 0
        other = F.when(even, i + 1).otherwise(i - 1)
        side = F.when(even, F.lit(RIGHT)).otherwise(F.lit(LEFT))
        sibling = F.when(other < F.size(digests), F.concat(side, F.get(digests, other))).otherwise(F.lit(""))
        return F.struct(level.alias("level"), (first + i).alias("place"), F.unhex(sibling).alias("step"))

    return F.transform(digests, step)


def paths(found: Forest, scratch: Scratch) -> DataFrame:
    """For every leaf (tree, place) the steps up to its subroot, by pointer jumping."""
    one = found.nodes.select("tree", "level", "place", F.array("step").alias("path"))
    leaves = scratch.keep(one.where("level = 0").drop("level"), "segments")
    upper, span = scratch.keep(_few(one.where("level > 0"), found.rows), "segments"), 1
    while span < found.height:
        # Segments end at a multiple of their span or at the subroot; those that start there are next.
        ends = upper.select(
            "tree", F.col("level").alias("end"), F.col("place").alias("ancestor"), F.col("path").alias("more")
        )
        below = leaves.select("tree", F.lit(0).alias("level"), "place", "path")
        leaves = scratch.keep(_longer(below, ends, span).drop("level"), "segments")
        again = upper.where(F.col("level") % (2 * span) == 0)
        upper = scratch.keep(_few(_longer(again, ends, span), found.rows >> (2 * span - 1)), "segments")
        span *= 2
    return leaves


def _few(nodes: DataFrame, rows: int) -> DataFrame:
    """Upper nodes in as many files as their number asks for, so that Spark knows small tables as such."""
    files = rows // ROWS_PER_FILE + 1
    return nodes.coalesce(files) if files < 64 else nodes


def _longer(nodes: DataFrame, ends: DataFrame, span: int) -> DataFrame:
    up = nodes.withColumn("ancestor", F.shiftright("place", span) if span < 63 else F.lit(0).cast("bigint"))
    up = up.withColumn("end", F.col("level") + span)
    joined = up.join(ends, ["tree", "end", "ancestor"], "left")
    path = F.concat("path", F.coalesce("more", F.array().cast("array<binary>")))
    return joined.select("tree", "level", "place", path.alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its steps come to."""

    def join(below: Column, step: Column) -> Column:
        other = F.lower(F.hex(F.substring(step, 2, 32)))
        both = F.when(F.hex(F.substring(step, 1, 1)) == LEFT, F.concat(other, below)).otherwise(F.concat(below, other))
        return sha256(both)

    return F.aggregate(path, leaf, join)


def siblings(path: Column) -> Column:
    """The digests of a path's siblings, in its order, laid end to end as hex text."""
    return F.array_join(F.transform(path, lambda step: F.lower(F.hex(F.substring(step, 2, 32)))), "")


def manifest(
    docs: DataFrame,
    scratch: Scratch,
    columns: list[str],
    id_column: str = "doc_id",
    group_column: str = "lang",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its id, leaf, subroot, root, path (its steps to the root) and changed_leaf.

    A leaf is the digest of ``columns``, null told apart from every text. Leaves stand
    in the order of the id (nulls first) below the subroot of their group; groups in
    the order of their UTF-8 bytes, null first. ``path`` has one step per level:
    side and digest of the sibling, or nothing where a node is hashed alone.
    ``changed_leaf`` is the leaf with some columns replaced by expressions over ``docs``
    (a replaced null stays null), to see whether the proof finds the change.

    Rows with equal ids stand in the order of their leaves; equal rows are
    interchangeable, so as a whole the result is the same. A table of one row is its
    own root with an empty path; no rows give no rows. Other columns are ignored.
    """
    changed = changed or {}
    own = {c: F.col(f"`{c}`") for c in columns}
    after = {c: changed.get(c, own[c]) for c in columns}
    leaves = docs.select(
        F.col(f"`{id_column}`").alias("id"),
        # Null sorts before every group, whatever its name.
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit("-")).alias("tree"),
        leaf_hash(list(own.values())).alias("leaf"),
        leaf_hash(list(after.values())).alias("changed_leaf"),
    )
    below = forest(scratch.keep(leaves, "leaves"), ["id"], scratch)
    # Subroots are the leaves of one more tree.
    groups = below.roots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("leaf"))
    above = forest(groups, ["group"], scratch)
    ways = above.leaves.join(above.roots.select("tree", F.col("subroot").alias("root")), "tree")
    ways = _with_path(ways, paths(above, scratch), "rest").select(
        F.col("group").alias("tree"), F.col("leaf").alias("subroot"), "root", "rest"
    )
    ways = scratch.keep(_few(ways, above.rows), "ways")
    rows = _with_path(below.leaves, paths(below, scratch), "path").join(ways, "tree")
    return rows.select(
        F.col("id").alias(id_column), "leaf", "subroot", "root", F.concat("path", "rest").alias("path"), "changed_leaf"
    )


def _with_path(leaves: DataFrame, found: DataFrame, name: str) -> DataFrame:
    joined = leaves.join(found, ["tree", "place"], "left")
    return joined.withColumn(name, F.coalesce("path", F.array().cast("array<binary>"))).select(*leaves.columns, name)
