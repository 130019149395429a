"""Near duplicates by circulant MinHash: two permutations make all coordinates of a signature.

The shingles of a document are points of a circle of ``CIRCLE`` places. The first
permutation scatters them; the second gives every place a value. Coordinate ``k`` of a
signature is the least value at the document's points after the values have been turned
by ``k`` places, so a point's values in all coordinates lie side by side in one table.
Coordinates far apart are joined to bands; documents with a band in common are
candidates, and candidates link by the exact Jaccard similarity of their full sets.

With 32 bands of 5 a pair at similarity 0.8 shares no band with probability 3e-6, and
pairs above with less.

1. Equal sets are one class; only classes go on.
2. Of the classes of a band, each is compared with the one that shares most bands with
   others, so a group of near copies costs as many comparisons as it has members.
3. What is connected by then needs no further comparison. Each class is below the class of
   highest rank that it was compared with; such a tree is a group. In a group that is not
   all connected every class outside its largest part is compared with all others of the
   group, whole blocks of sets at a time: no pair is listed but those that link.
4. In the bands that are left, classes of different groups are compared where their
   signatures agree as often as linked ones do.

Sets meet in blocks: a task gets those of two blocks at a time, once, for all
comparisons between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from weftgraph.llm import grams
from weftgraph.llm.components import components
from weftgraph.operators.ranking import numbered
from weftgraph.scratch import Scratch

# Places of the circle, which the table of values has in memory: 4 MB.
CIRCLE_BITS = 20
BANDS, ROWS = 32, 5
SEEDS = (0x5DEECE66D, 0x27BB2EE687B0B0FD)
# Signatures are also compared by one bit of each of so many coordinates.
BITS = 128
BLOCK, LARGE = 256, 1 << 13
# A block in a group holds fewer sets where they are so large that their shingles would be more than this.
BLOCK_SHINGLES = 1 << 21
SALTS = 32
TABLE_BITS = 26
# Rows of a band that one task compares with all others of it.
ROWS_AT_ONCE = 512


@lru_cache(1)
def _tables(bits: int, coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and for each place its values in all coordinates."""
    places = np.arange(1 << bits, dtype=np.uint64)
    first, second = (np.argsort(grams.mixed(places + np.uint64(seed)), kind="stable").astype(np.uint32) for seed in SEEDS)
    circle = np.concatenate([second, second[: coordinates - 1]])
    return first, np.lib.stride_tricks.sliding_window_view(circle, coordinates)


def signature(tokens: np.ndarray, coordinates: int, bits: int = CIRCLE_BITS) -> np.ndarray:
    """The circulant signature of a set of 64-bit shingle hashes, which must not be empty."""
    scattered, values = _tables(bits, coordinates)
    points = scattered[(tokens >> np.uint64(64 - bits)).astype(np.int64)]
    found = values[points[0]].copy()
    for at in range(0, len(points), 2048):
        np.minimum(found, values[points[at : at + 2048]].min(axis=0), out=found)
    return found


def shingle_sets(block: grams.Block, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document; one hash of all words of a document that has fewer."""
    hashes = block.hashes(shingle)[0]
    for start, count in zip(block.starts, block.counts):
        if count >= shingle:
            yield np.unique(hashes[start : start + count - shingle + 1])
        elif count:
            whole = grams.rolled(block.lanes[0][start : start + count], count, grams.BASES[1])
            yield grams.mixed(whole + np.uint64(count))
        else:
            yield np.empty(0, dtype=np.uint64)


def _sets(batch: pa.RecordBatch, column: int, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    for block in grams.blocks(grams.text_bytes(batch.column(column)), grams.lower_words):
        yield from zip(block.rows.tolist(), shingle_sets(block, shingle))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_SCANNED = "id bigint, size int, set binary, bands array<bigint>, bits0 bigint, bits1 bigint"


def _scan(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per document the size and digest of its set, its bands and the bits of its signature; an empty set is one of its own."""
    coordinates = max(bands * rows, BITS)

    def of_set(tokens: np.ndarray) -> tuple:
        values = signature(tokens, coordinates)
        keys = []
        for band in range(bands):
            key = np.append(values[band : bands * rows : bands], np.uint32(band)).tobytes()
            keys.append(_signed(xxh3_64_intdigest(key)))
        lanes = np.packbits((grams.mixed(values[:BITS].astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).view(np.int64)
        return len(tokens), xxh3_128_digest(tokens.tobytes()), keys, int(lanes[0]), int(lanes[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for row, tokens in _sets(batch, 1, shingle):
                at.append(row)
                found.append(of_set(tokens) if len(tokens) else (0, None, [], 0, 0))
                if len(found) == 1024:
                    yield _rows(batch, at, found)
                    at, found = [], []
            if found:
                yield _rows(batch, at, found)

    return docs.mapInArrow(run, _SCANNED)


def _rows(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
    sizes, digests, keys, *lanes = zip(*found)
    arrays = [
        pa.array(sizes, type=pa.int32()),
        pa.array(digests, type=pa.binary()),
        pa.array(keys, type=pa.list_(pa.int64())),
        *[pa.array(lane, type=pa.int64()) for lane in lanes],
    ]
    names = ["id", "size", "set", "bands", "bits0", "bits1"]
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *arrays], names=names)


def _table_of(ids: DataFrame) -> np.ndarray:
    """A table of bits with those of the ids set: 16 for each id, 2^TABLE_BITS at most, so 8 MB whatever the corpus holds.

    Where there are too many ids for it, more rows pass than need to.
    """
    bits = min(max((ids.count() * 16 - 1).bit_length(), 6), TABLE_BITS)
    bit = F.crc32(F.col("id").cast("string").cast("binary")).bitwiseAND(F.lit((1 << bits) - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
    words = ids.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return np.unpackbits(table.view(np.uint8), bitorder="little")


def _sets_of(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """The full sets of the rows (id, text) with one of the ids, and perhaps of some more: class, tokens."""
    wanted = docs.sparkSession.sparkContext.broadcast(np.packbits(_table_of(ids), bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.unpackbits(wanted.value, bitorder="little")
        for batch in batches:
            signs = np.array([crc32(str(i).encode()) for i in batch.column(0).to_pylist()], dtype=np.int64)
            chosen = np.flatnonzero(table[signs & (len(table) - 1)])
            found = [t for _, t in _sets(batch.take(pa.array(chosen)), 1, shingle) if len(t)]
            packs = [t.tobytes() for t in found]
            digests = [xxh3_128_digest(p) for p in packs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, type=pa.binary()), pa.array(packs, type=pa.binary())], names=["class", "tokens"]
            )

    return docs.mapInArrow(run, "class binary, tokens binary")


def least_bits(percent: int) -> int:
    """Bits in which the signatures of linked sets agree, eight standard deviations below the mean (a chance below 1e-12)."""
    mean = BITS * (1 + percent / 100) / 2
    return int(mean - 8 * (mean * (1 - mean / BITS)) ** 0.5)


def _may_link(percent: int) -> Column:
    """Whether sizes and signatures of two classes allow a link."""
    apart = [F.bit_count(F.col(f"{b}_a").bitwiseXOR(F.col(f"{b}_b"))) for b in ("bits0", "bits1")]
    sizes = (F.col("size_a") * 100 >= F.col("size_b") * percent) & (F.col("size_b") * 100 >= F.col("size_a") * percent)
    return sizes & (apart[0] + apart[1] <= BITS - least_bits(percent))


def _pieces() -> Column:
    return F.floor(F.col("members") / ROWS_AT_ONCE) + 1


def _dealt(rows: DataFrame, by: Column) -> DataFrame:
    """Rows of bands dealt out by ``piece``, of which large bands have several."""
    return rows.withColumn("piece", F.pmod(by, _pieces()))


def _copied(rows: DataFrame) -> DataFrame:
    """Rows of bands, once for each piece of their band."""
    return rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), _pieces() - 1)))


def _side(rows: DataFrame, name: str, *more: str) -> list[Column]:
    """The key, and the columns of one class of a pair."""
    return [rows["key"], *[rows[c].alias(f"{c}_{name}") for c in ("no", "size", "bits0", "bits1", *more)]]


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of numbers whose full sets link. A set of more than ``LARGE`` shingles is a block alone."""
    blocked = pairs.join(sets.select(F.col("no").alias("a"), F.col("block").alias("block_a")), "a")
    blocked = blocked.join(sets.select(F.col("no").alias("b"), F.col("block").alias("block_b")), "b")
    blocked = blocked.select("block_a", "block_b", "a", "b")
    blocks = (F.col("block_a").alias("one"), F.col("block_b").alias("other"))
    ends = [blocked.select(*blocks, F.col(end).alias("no")) for end in "ab"]
    needed = ends[0].unionByName(ends[1]).distinct().join(sets.select("no", "tokens"), "no")

    def compare(some_pairs: pd.DataFrame, some_sets: pd.DataFrame) -> pd.DataFrame:
        packs = [np.frombuffer(t, dtype=np.uint64) for t in some_sets["tokens"]]
        place = {no: i for i, no in enumerate(some_sets["no"])}
        distinct, dense = np.unique(np.concatenate(packs), return_inverse=True) if packs else (np.empty(0), np.empty(0))
        ends = np.cumsum([0, *map(len, packs)])
        mark, last, kept = np.zeros(len(distinct), dtype=bool), None, []
        for a, b in sorted(zip(some_pairs["a"], some_pairs["b"])):
            i, j = place[a], place[b]
            own, other = dense[ends[i] : ends[i + 1]], dense[ends[j] : ends[j + 1]]
            if a != last:
                mark[:] = False
                mark[own] = True
                last = a
            both = int(np.count_nonzero(mark[other]))
            if 100 * both >= percent * (len(own) + len(other) - both):
                kept.append((a, b))
        return pd.DataFrame(kept, columns=["a", "b"])

    return blocked.groupBy("block_a", "block_b").cogroup(needed.groupBy("one", "other")).applyInPandas(compare, "a bigint, b bigint")


def _roots(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The top of each class's tree: no, root. Of ``pairs`` (a, b, degree of b) a class's best one says what it is below.

    Ways double with each join, and pairs lead to higher ranks only, so they end.
    """
    best = pairs.groupBy(F.col("a").alias("no")).agg(F.max(F.struct("degree", "b")).alias("best"))
    way = scratch.keep(best.select("no", F.col("best.b").alias("root")), "ways")
    while True:
        on = way.select(F.col("no").alias("root"), F.col("root").alias("next"))
        longer = scratch.keep(way.join(on, "root", "left").select("no", F.coalesce("next", "root").alias("root"), "next"), "ways")
        way = longer.drop("next")
        if longer.where("next IS NOT NULL").isEmpty():
            return way


def _links_in_groups(classes: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes (no, size, component, group) of different components of a group.

    A group's classes are numbered, those outside its largest component first. Blocks of
    consecutive classes hold at most ``BLOCK`` of them, and fewer of large ones; every
    block with classes outside meets every later block and itself in one task.
    """
    parts = classes.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("top"))
    opened = parts.groupBy("group").agg(
        F.max(F.struct("n", "component")).alias("main"),
        F.sum("n").alias("all"),
        F.max("top").alias("top"),
        F.count(F.lit(1)).alias("parts"),
    )
    width = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_SHINGLES) / F.col("top")))).cast("bigint")
    opened = opened.where("parts > 1").select(
        "group", F.col("main.component").alias("main"), (F.col("all") - F.col("main.n")).alias("outsiders"), "all", width.alias("width")
    )
    opened = scratch.keep(opened, "open_groups")
    members = classes.join(opened, "group").withColumn("inside", F.col("component") == F.col("main")).drop("main", "size")
    ranked = numbered(scratch.keep(members, "members"), ["group", "inside", "no"], "place", scratch, within="group")
    block = F.floor(F.col("place") / F.col("width"))
    last, last_outside = (F.floor((F.col(c) - 1) / F.col("width")) for c in ("all", "outsiders"))
    ranked = ranked.select("group", "no", "place", "component", "inside", block.alias("block"), last.alias("last"), last_outside.alias("last_outside"))
    ranked = scratch.keep(ranked, "ranked")
    # All classes of a later or the same block, and those outside of an earlier block.
    later = ranked.withColumn("one", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least("block", "last_outside"))))
    later = later.withColumn("other", F.col("block"))
    ahead = ranked.where(~F.col("inside") & (F.col("block") < F.col("last")))
    ahead = ahead.withColumn("one", F.col("block")).withColumn("other", F.explode(F.sequence(F.col("block") + 1, F.col("last"))))
    meeting = later.unionByName(ahead).select("group", "one", "other", "no", "place", "component", "inside", "block")
    meeting = meeting.join(sets.select("no", "tokens"), "no")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", kind="stable")
        packs = [np.frombuffer(t, dtype=np.uint64) for t in rows["tokens"]]
        distinct, dense = np.unique(np.concatenate(packs), return_inverse=True)
        sizes = np.array([len(p) for p in packs])
        ends = np.cumsum(sizes)
        numbers, parts = rows["no"].to_numpy(), rows["component"].to_numpy()
        first = (rows["block"] == rows["one"]).to_numpy() & ~rows["inside"].to_numpy()
        second = np.flatnonzero((rows["block"] == rows["other"]).to_numpy())
        begin = ends[second[0]] - sizes[second[0]]
        starts, tail = ends[second] - sizes[second] - begin, dense[begin:]
        mark, kept = np.zeros(len(distinct), dtype=bool), []
        for i in np.flatnonzero(first):
            own = dense[ends[i] - sizes[i] : ends[i]]
            mark[own] = True
            shared = np.add.reduceat(mark[tail], starts, dtype=np.int64)
            mark[own] = False
            union = sizes[i] + sizes[second] - shared
            linked = (100 * shared >= percent * union) & (second > i) & (parts[second] != parts[i])
            kept += [(max(numbers[i], numbers[j]), min(numbers[i], numbers[j])) for j in second[linked]]
        return pd.DataFrame(kept, columns=["a", "b"])

    return meeting.groupBy("group", "one", "other").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 2,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id, n_shingles (size of its set), component_id, kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a shingle is
    ``shingle`` consecutive words, or the whole text if it has fewer. Documents link when
    100 * intersection >= ``percent`` * union; component_id is the least id reachable by
    links, the document's own included, and ``kept`` says that it is the document's own.

    A null or empty text has an empty set and links with nothing. Rows that repeat an id
    are one document as to links, each with the size of its own set. A row with a null id
    has no component (null) and is kept; its text links nothing. No rows give no rows;
    other columns are ignored. Ids must be integers.

    Sets hold 64-bit hashes of shingles. ``percent`` below 80 asks for more or shorter
    bands: a link at similarity s is missed with probability (1 - s ** rows) ** bands.
    """
    if not 80 <= percent <= 100 and (bands, rows) == (BANDS, ROWS):
        raise ValueError(f"percent {percent} needs bands of its own")
    source = docs.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    scanned = scratch.keep(_scan(source, shingle, bands, rows), "scanned")
    with Scratch(docs.sparkSession) as passing:
        found = scratch.keep(_components(source, scanned, passing, shingle, percent), "components")
    sizes = scanned.select("id", "size", _class_of(), _salt())
    return sizes.join(found, ["class", "salt"], "left").select(
        F.col("id").alias(id_column),
        F.col("size").cast("bigint").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
    )


def _class_of() -> Column:
    """Rows of equal sets are one class; an empty set is one with those of its id."""
    return F.coalesce(F.col("set"), F.concat(F.lit("#"), F.col("id").cast("string")).cast("binary")).alias("class")


def _salt() -> Column:
    """Parts that a large class is dealt out by."""
    return F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")


def _components(source: DataFrame, scanned: DataFrame, scratch: Scratch, shingle: int, percent: int) -> DataFrame:
    """The component of each class, once for each salt that its rows have: class, salt, component."""
    rows = scanned.where(F.col("id").isNotNull())
    # Copies are combined in tasks, then by salt, then as a whole.
    salted = rows.groupBy(_class_of(), _salt()).agg(
        F.min("id").alias("first"), *[F.first(c).alias(c) for c in ("size", "bands", "bits0", "bits1")]
    )
    salted = scratch.keep(salted, "salted")
    classes = salted.groupBy("class").agg(
        F.min("first").alias("first"), *[F.first(c).alias(c) for c in ("size", "bands", "bits0", "bits1")]
    )
    classes = scratch.keep(classes, "classes")

    # Bands of two classes at least, counted by salt first.
    salt = F.pmod(F.xxhash64("class"), F.lit(SALTS)).cast("int").alias("salt")
    keys = classes.select("class", salt, F.explode("bands").alias("key"))
    counted = keys.groupBy("key", "salt").agg(F.count(F.lit(1)).alias("n"))
    common = counted.groupBy("key").agg(F.sum("n").alias("members"), F.collect_set("salt").alias("salts")).where("members > 1")
    common = common.select("key", "members", F.explode("salts").alias("salt"))
    members = scratch.keep(keys.join(common, ["key", "salt"]).drop("salt"), "members")
    degree = members.groupBy("class").agg(F.sum("members").alias("degree"))
    ranked = scratch.keep(members.join(degree, "class"), "ranked")
    centres = ranked.groupBy("key", "members").agg(F.max(F.struct("degree", "class")).alias("centre"))
    by_class = F.xxhash64("class")
    placed = _dealt(ranked, by_class).join(_copied(centres).drop("members"), ["key", "piece"])
    placed = scratch.keep(placed.select("key", "class", "members", "degree", "centre"), "placed")

    # Numbers in the order of the centre that a class is compared with, so that pairs fall into few blocks.
    candidates = placed.groupBy("class").agg(F.max("centre").alias("centre"))
    candidates = candidates.join(classes.select("class", "first", "size", "bits0", "bits1"), "class")
    candidates = candidates.select("class", F.col("centre.class").alias("near"), "first", "size", "bits0", "bits1")
    candidates = scratch.keep(numbered(scratch.keep(candidates, "candidates"), ["near", "class"], "no", scratch), "numbers")
    large = F.col("size") > LARGE
    block = F.when(large, -F.col("no") - 1).otherwise(F.floor(F.col("no") / BLOCK))
    packs = _sets_of(source.where("id IS NOT NULL"), candidates.select(F.col("first").alias("id")), shingle)
    packs = packs.groupBy("class").agg(F.first("tokens").alias("tokens"))
    sets = packs.join(candidates.select("class", "no", block.alias("block")), "class").drop("class")
    sets = scratch.keep(sets, "sets")

    known = scratch.keep(placed.join(candidates.drop("near", "first"), "class"), "known")
    centre = known.where(F.col("centre.class") == F.col("class"))
    known = known.drop("class", "centre")
    stars = _dealt(known, F.col("no")).select("piece", *_side(known, "a")).join(
        _copied(centre).select("piece", F.col("degree").alias("degree_b"), *_side(centre, "b")), ["key", "piece"]
    )
    # A band's centre has the highest rank in it, so pairs lead from a class to one above it.
    stars = stars.where((F.col("no_a") != F.col("no_b")) & _may_link(percent))
    stars = stars.groupBy(F.col("no_a").alias("a"), F.col("no_b").alias("b")).agg(F.max("degree_b").alias("degree"))
    stars = scratch.keep(stars, "pairs")
    links = scratch.keep(_verified(stars.select("a", "b"), sets, percent), "links")

    # What was compared is one group, what linked is connected: trees of classes below their centres.
    groups = _roots(stars, scratch).withColumnRenamed("root", "group")
    connected = _roots(links.join(stars, ["a", "b"]), scratch).withColumnRenamed("root", "component")
    grouped = candidates.select("no", "size").join(connected, "no", "left").join(groups, "no", "left")
    grouped = grouped.select("no", "size", F.coalesce("component", "no").alias("component"), F.coalesce("group", "no").alias("group"))
    grouped = scratch.keep(grouped, "grouped")
    inside = _links_in_groups(grouped, sets, percent, scratch)

    # Bands with classes of several components.
    labelled = scratch.keep(known.join(grouped.drop("size"), "no"), "labelled")
    parts = labelled.groupBy("key", "members", "component").agg(F.count(F.lit(1)).alias("n"))
    main = parts.groupBy("key", "members").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = _copied(main.where("parts > 1").select("key", "members", F.col("main.component").alias("main")))
    opened = _dealt(labelled, F.col("no")).join(main.drop("members"), ["key", "piece"]).drop("piece")
    opened = scratch.keep(opened.withColumn("outside", F.col("component") != F.col("main")).drop("main", "degree"), "open")
    # Each class outside is compared with all classes of its band; large bands in several tasks.
    outside = _dealt(opened.where("outside"), F.col("no"))
    outside = outside.select("piece", *_side(outside, "a", "component", "group"))
    others = _copied(opened)
    others = others.select("piece", *_side(others, "b", "component", "group", "outside"))
    once = (F.col("no_a") > F.col("no_b")) | ~F.col("outside_b")
    apart = (F.col("component_a") != F.col("component_b")) & (F.col("group_a") != F.col("group_b"))
    crossing = outside.join(others, ["key", "piece"]).where(apart & once & _may_link(percent))
    crossing = crossing.select(F.greatest("no_a", "no_b").alias("a"), F.least("no_a", "no_b").alias("b")).distinct()
    more = _verified(scratch.keep(crossing, "pairs"), sets, percent).unionByName(inside)

    all_links = scratch.keep(links.unionByName(more), "links")
    firsts = candidates.select("no", "first")
    by_id = all_links.join(firsts.withColumnRenamed("no", "a").withColumnRenamed("first", "x"), "a")
    by_id = by_id.join(firsts.withColumnRenamed("no", "b").withColumnRenamed("first", "y"), "b")
    by_id = by_id.select(F.col("x").alias("a"), F.col("y").alias("b"))
    # An id that rows of several classes have connects them.
    repeated = rows.select("id", _class_of()).groupBy("id").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    repeated = repeated.where("least < most").select("id")
    if not scratch.keep(repeated, "repeated").isEmpty():
        same = rows.join(repeated, "id").select(_class_of(), "id").distinct().join(classes.select("class", "first"), "class")
        by_id = by_id.unionByName(same.select(F.col("id").alias("a"), F.col("first").alias("b")))
    found = scratch.keep(components(by_id, scratch), "found")
    of_class = salted.select("class", "salt").join(classes.select("class", "first"), "class")
    return of_class.join(found.withColumnRenamed("node", "first"), "first", "left").select(
        "class", "salt", F.coalesce("component", "first").alias("component")
    )
