"""Mixing sources to target weights by proportionate fair scheduling of blocks.

A source's documents are cut into blocks in a random but fixed order. With integer
weights, block ``k`` of a source of weight ``w`` is released when the ideal, evenly
flowing mix has given the source ``k`` blocks, and due when it has given ``k + 1``.
Each slot goes to the released block that is due first. At any slot each source has
then had less than one block more or less than the ideal mix. Where a source runs
out, the ideal mix goes on with the weights of the others, so every document is
placed.

Weights keep 40 bits at least, and 20 bits more than the number of blocks has, so the
mix follows the target weights themselves: rounding moves no source by a millionth of a
block in all. The driver walks once through all blocks (one for ``block_rows`` rows, 64
by default) and holds a source and a number for each; rows never come to it.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from weftgraph.functions.types import quoted
from weftgraph.operators.ranking import numbered
from weftgraph.scratch import Scratch

# The least sum of integer weights, and how many times the number of blocks it is at least.
ROUND = 1 << 40
PER_BLOCK = 1 << 20
BLOCK_ROWS = 64
# Rows of the table of blocks that may be broadcast (about 40 bytes each).
BROADCAST_ROWS = 1 << 20


def integer_weights(weights: Mapping[str, float], round_slots: int = ROUND) -> dict[str, int]:
    """Weights as integers that add up to ``round_slots``, by largest remainder, at least one each."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    own = {s: Fraction(w) for s, w in weights.items()}
    total, slots = sum(own.values()), max(round_slots, len(weights))
    exact = {s: w / total * slots for s, w in own.items()}
    found = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s)):
        if sum(found.values()) >= slots:
            break
        found[s] += 1
    return found


def round_schedule(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[tuple[str, int]]:
    """The (source, block) of each slot of a mix in which source ``s`` has ``blocks[s]`` blocks."""
    ideal = _ideal_times(weights, blocks)
    waiting = [(Fraction(0), s, 0) for s, n in sorted(blocks.items()) if n]
    heapq.heapify(waiting)
    due: list[tuple[Fraction, str, int]] = []
    order = []
    for time in ideal:
        # Released before the ideal mix ends this slot.
        while waiting and waiting[0][0] < time:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(due, (Fraction(k + 1, weights[s]), s, k))
        _, s, k = heapq.heappop(due)
        order.append((s, k))
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, (Fraction(k + 1, weights[s]), s, k + 1))
    return order


def _ideal_times(weights: Mapping[str, int], blocks: Mapping[str, int]) -> list[Fraction]:
    """When the ideal mix has given 1, 2, ... blocks in all: each source gets its weight per unit of time until it runs out."""
    ends = sorted((Fraction(n, weights[s]), weights[s]) for s, n in blocks.items() if n)
    rate, begin, given, times = sum(w for _, w in ends), Fraction(0), Fraction(0), []
    for end, weight in ends:
        while len(times) + 1 <= given + rate * (end - begin):
            times.append(begin + (len(times) + 1 - given) / rate)
        given += rate * (end - begin)
        begin, rate = end, rate - weight
    return times


def tempered_weights(sizes: Mapping[str, int], exponent: float) -> dict[str, float]:
    """Weights between equal shares (exponent 0) and shares by size (1)."""
    return {s: n**exponent for s, n in sizes.items()}


def source_sizes(docs: DataFrame, source_column: str = "source") -> dict[str, int]:
    """Rows of each source under its key; one row per source comes to the driver, like the weights."""
    rows = docs.groupBy(_key(source_column).alias("key")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["key"]: r["n"] for r in rows}


def source_key(source: str | None) -> str:
    """The name by which weights are given; null is a source of its own."""
    return "none" if source is None else f"source {source}"


def _key(column: str):
    return F.coalesce(F.concat(F.lit("source "), quoted(column).cast("string")), F.lit("none"))


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float],
    scratch: Scratch,
    id_column: str = "doc_id",
    source_column: str = "source",
    block_rows: int = BLOCK_ROWS,
    seed: int = 7,
    sizes: Mapping[str, int] | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Each row of ``docs`` with its place in the mix: struct ``row`` (its columns), source_block, slot, place.

    Sorted by (slot, place) the rows are the mixed stream. ``weights`` are by
    ``source_key``; sources without one are an error, weights without rows are ignored. A
    source's order is by a hash of the id; rows that agree in id and all else are
    interchangeable. A null source is a source, a null id an id like any other. No
    rows give no rows. All columns, whatever their names, stay inside ``row``.
    """
    sizes = source_sizes(docs, source_column) if sizes is None else sizes
    missing = sorted(set(sizes) - set(weights))
    if missing:
        raise ValueError(f"no weight for {missing[:5]}")
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    slots = max(ROUND, PER_BLOCK * sum(blocks.values()))
    order = round_schedule(integer_weights({s: weights[s] for s in sizes}, slots), blocks) if sizes else []
    table = pa.table(
        {
            "key": pa.array([s for s, _ in order], type=pa.string()),
            "source_block": pa.array([k for _, k in order], type=pa.int64()),
            "slot": pa.array(range(len(order)), type=pa.int64()),
        }
    )
    schedule = docs.sparkSession.createDataFrame(table)
    if len(order) <= BROADCAST_ROWS:
        schedule = F.broadcast(schedule)
    rows = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("row"),
        _key(source_column).alias("key"),
        F.xxhash64(quoted(id_column), F.lit(seed)).alias("mix"),
        F.monotonically_increasing_id().alias("number"),
    )
    total = sum(sizes.values())
    ranked = numbered(
        rows, ["key", "mix", "number"], "rank", scratch, within="key", total=total, rows_per_range=rows_per_range
    )
    placed = ranked.select(
        "row",
        "key",
        F.expr(f"rank div {int(block_rows)}").alias("source_block"),
        (F.col("rank") % block_rows).cast("int").alias("place"),
    )
    return placed.join(schedule, ["key", "source_block"]).select("row", "source_block", "slot", "place")
