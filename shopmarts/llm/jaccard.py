"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersection of sorted arrays.

Two documents link when the Jaccard similarity of their sets of five-word shingles is at least 0.75.
No link is lost and no pair is compared without need:

1. Every set is ordered from rare to common shingles, by a table of counts of fixed size that is
   summed over all documents. Linked sets share one of their first shingles (the prefix of a quarter
   of the set; of a seventh for the shorter set of a pair).
2. A *tile* holds the documents with one prefix shingle within one band of sizes. Linked sets differ
   in size by a third at most, so a set stands in its own band and, near the lower edge, as a guest
   in the band below. Equal sets are one class with one representative. Classes and tiles meet as
   packed arrays in ranges of tiles; tiles of one class go, and tiles of the same documents are one.
3. Every document of a tile is compared with the tile's smallest document id first. That joins the
   groups of true copies with as many comparisons as members, and not with their square.
4. Bitmaps of the shingles' hashes bound the overlap of a pair from above, by the bits that only one
   side has; what passes is intersected exactly. Only these pairs meet their arrays, which are cut to
   the ids of the pairs before they are joined.
5. Tiles whose documents are still not connected are compared in full: small ones pair by pair, each
   pair once for all its tiles; larger ones in cells of bounded size, where pairs that are connected
   already are skipped, and which return the links that connect them, not all their links.

Shingles are 64-bit hashes: two different shingles of one pair are taken for one with a probability
of 2^-64 each. Classes are told apart by 128 bits.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.components import components
from shopmarts.llm.memory import tidy
from shopmarts.llm.words import GOLDEN, NOT_SPACE, _mixed, blocks, find_words, shingle_hashes
from shopmarts.session import scratch_dir

SHINGLE = 5
TABLE_BITS = 20  # of the table of counts: 4 MB, whatever the input's size
ENTRIES_HELD = 2_000_000  # of a task before it passes them on, about 32 MB
RANGES_PER_PARTITION = 4
BITMAP_BITS = 24  # 2 MB, whatever the number of candidates
SMALL_TILE = 24  # members of a tile that is compared pair by pair
CELL_SHINGLES = 400_000  # of one side of a cell, about 3 MB


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text its distinct shingles as ascending unsigned 64-bit hashes."""
    for _, part in blocks(texts):
        found = find_words(part, NOT_SPACE)
        full = shingle_hashes(found.hash, SHINGLE)
        for first, count in zip(found.first.tolist(), found.counts.tolist(), strict=False):
            if count >= SHINGLE:
                yield np.unique(full[first : first + count - SHINGLE + 1])
            else:
                yield shingle_hashes(found.hash[first : first + count], max(count, 1))


def _prefix(n: int) -> int:
    """So many of its rarest shingles a set must be looked up by."""
    return n - (3 * n + 3) // 4 + 1


def _early_prefix(n: int) -> int:
    """The same for the shorter set of a pair."""
    return n - (6 * n + 6) // 7 + 1


def _band(n: int) -> int:
    return (n.bit_length() - 1) // 2  # sizes 4^b to 4^(b+1) - 1


SETS = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "n", "class_a", "class_b")] + [("counts", pa.binary())]
)


def _sets(documents: DataFrame) -> DataFrame:
    """Per document its set's size and 128-bit class; beside that a row per task with the number of
    its documents that have a shingle of each hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << TABLE_BITS, np.uint32)
        for batch in batches:
            rows = []
            for shingles in shingle_sets(batch.column(1)):
                np.add.at(table, (shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64), 1)
                rows.append((len(shingles), *_class(shingles)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.record_batch(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in columns), pa.nulls(len(rows), pa.binary())],
                schema=SETS,
            )
        none = [pa.nulls(1, pa.int64())] * 4
        # Counts only order the shingles; 255 documents of one task are many enough.
        small = np.minimum(table, 255).astype(np.uint8)
        yield pa.record_batch([*none, pa.array([small.tobytes()], pa.binary())], schema=SETS)

    return documents.mapInArrow(
        tidy(run), "doc_id long, n long, class_a long, class_b long, counts binary"
    )


def _class(shingles: np.ndarray) -> tuple[int, int]:
    mixed = _mixed(shingles + np.uint64(GOLDEN))
    sums = (mixed.sum(dtype=np.uint64), (mixed * mixed).sum(dtype=np.uint64))
    return tuple(int(x.view(np.int64)) for x in sums)


def _counts(sets: DataFrame) -> np.ndarray:
    """The tasks' tables added up. Eight partial sums of fixed size come to the driver."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << TABLE_BITS, np.uint32)
        for batch in batches:
            for counts in batch.column(0):
                table += np.frombuffer(counts.as_buffer(), np.uint8)
        yield pa.record_batch([pa.array([table.tobytes()], pa.binary())], names=["counts"])

    parts = sets.where("counts IS NOT NULL").select("counts")
    sums = parts.repartition(8).mapInArrow(tidy(total), "counts binary")
    zero = np.zeros(1 << TABLE_BITS, np.int64)
    return sum((np.frombuffer(row[0], np.uint32) for row in sums.toLocalIterator()), zero)


def _entries(documents: DataFrame, counts: np.ndarray, ranges: int) -> DataFrame:
    """Which tiles each class of sets stands in, as packed arrays cut into ranges of tiles.

    An entry is a tile's 62-bit hash with two flags, whether the set is at home in the tile's band (or
    a guest from the band above) and whether it may be the shorter of a pair there; and the class. A
    task lists a class once, however many copies it reads.
    """
    # Saturating at 2^20 keeps the count and 44 bits of the hash in one sort key.
    shared = documents.sparkSession.sparkContext.broadcast(
        np.minimum(counts, (1 << 20) - 1).astype(np.uint32)
    )
    width = (1 << 64) // ranges + 1
    bounds = np.array([r * width for r in range(1, ranges)], np.uint64)

    def packed(tiles: list[np.ndarray], classes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        joint, owner = np.concatenate(tiles), np.concatenate(classes)
        order = np.argsort(joint)
        joint, owner = joint[order], owner[order]
        cuts = np.searchsorted(joint, bounds)
        for r, (x, y) in enumerate(zip(np.split(joint, cuts), np.split(owner, cuts), strict=True)):
            if len(x):
                yield pa.record_batch(
                    [pa.array([r], pa.int32()), pa.array([x.tobytes()]), pa.array([y.tobytes()])],
                    names=["range", "tiles", "classes"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        listed: set[tuple[int, int]] = set()
        tiles: list[np.ndarray] = []
        classes: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for shingles in shingle_sets(batch.column(0)):
                own = _class(shingles)
                if not len(shingles) or own in listed:
                    continue
                listed.add(own)
                tiles.append(_tiles(shingles, table))
                classes.append(np.full(len(tiles[-1]), own[0], np.int64))
                held += len(tiles[-1])
                if held >= ENTRIES_HELD:
                    yield from packed(tiles, classes)
                    tiles, classes, held = [], [], 0
        if tiles:
            yield from packed(tiles, classes)

    return documents.select("text").mapInArrow(tidy(run), "range int, tiles binary, classes binary")


def _tiles(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The set's tiles with their flags: for its rarest shingles, in its own band and, near the lower
    edge, in the band below."""
    n = len(shingles)
    rare = counts[(shingles >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
    order = rare.astype(np.uint64) << np.uint64(44) | shingles >> np.uint64(20)
    kept = shingles[np.argsort(order, kind="stable")[: _prefix(n)]]
    band = _band(n)
    home = _tile(kept, band) | np.uint64(2)
    home[: _early_prefix(n)] |= np.uint64(1)
    if (3 * n + 3) // 4 >= 4**band:
        return home
    return np.concatenate([home, _tile(kept, band - 1)])


def _tile(shingles: np.ndarray, band: int) -> np.ndarray:
    salt = np.uint64((band + 1) * GOLDEN & (1 << 64) - 1)
    return _mixed(shingles ^ salt) & ~np.uint64(3)


def _standing(entries: DataFrame) -> DataFrame:
    """``tile, class_a, home, early`` of the tiles that hold more than one class and a possibly
    shorter one."""

    def run(rows: pa.Table) -> pa.Table:
        tiles, classes = (
            np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column(name)])
            for name in ("tiles", "classes")
        )
        order = np.lexsort((classes, tiles))
        tiles, classes = tiles[order], classes[order]
        other = np.ones(len(tiles), bool)
        other[1:] = (tiles[1:] != tiles[:-1]) | (classes[1:] != classes[:-1])
        tiles, classes = tiles[other], classes[other]
        key = tiles & ~np.uint64(3)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        members = np.diff(np.append(first, len(key)))
        early = np.logical_or.reduceat(tiles & np.uint64(1) > 0, first)
        keep = np.repeat((members > 1) & early, members)
        tiles, classes, key = tiles[keep], classes[keep], key[keep]
        return pa.table(
            {
                "tile": key.view(np.int64),
                "class_a": classes.view(np.int64),
                "home": tiles & np.uint64(2) > 0,
                "early": tiles & np.uint64(1) > 0,
            }
        )

    return entries.groupBy("range").applyInArrow(
        run, "tile long, class_a long, home boolean, early boolean"
    )


def _arrays(documents: DataFrame, needed: DataFrame) -> DataFrame:
    """The sorted shingles of the needed documents, and of a few others whose ids share a bit of the
    bitmap, which has a fixed size. The texts are not moved."""
    spark = documents.sparkSession
    bit = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - BITMAP_BITS).cast("int")
    words = (
        needed.select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"))
    )
    marked = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for word, bits in words.toLocalIterator():
        marked[word] = bits
    shared = spark.sparkContext.broadcast(marked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value.view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            some = batch.filter(pa.array(bits[batch.column(2).to_numpy()]))
            sets = [x.view(np.int64) for x in shingle_sets(some.column(1))]
            bitmaps = [signature(x.view(np.uint64)) for x in sets]
            yield pa.record_batch(
                [
                    some.column(0),
                    pa.array(sets, pa.list_(pa.int64())),
                    pa.array(bitmaps, pa.binary()),
                    pa.array([len(x) for x in sets], pa.int64()),
                ],
                names=["doc_id", "shingles", "bitmap", "n"],
            )

    return (
        documents.where("doc_id IS NOT NULL")
        .select("doc_id", "text", bit.alias("bit"))
        .mapInArrow(tidy(run), "doc_id long, shingles array<long>, bitmap binary, n long")
    )


def signature(shingles: np.ndarray) -> bytes:
    """A bitmap of the shingles' hashes: 4 to 8 bits a shingle, a power of two in all."""
    words = 1 << max((4 * max(len(shingles), 1) - 1).bit_length() - 6, 0)
    return _bitmap(shingles, words).tobytes()


def may_link(a: bytes, n_a: int, b: bytes, n_b: int) -> bool:
    """False only for sets that cannot link: a bit that one side alone has stands for a shingle that
    the other lacks. The longer bitmap is folded to the length of the other."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    x = np.bitwise_or.reduce(x.reshape(-1, words))
    y = np.bitwise_or.reduce(y.reshape(-1, words))
    only_x = int(np.bitwise_count(x & ~y).sum())
    only_y = int(np.bitwise_count(y & ~x).sum())
    bound = min(n_a - only_x, n_b - only_y)
    return 100 * bound >= 75 * (n_a + n_b - bound)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two ascending arrays without repeats share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, in integers."""
    n = len(a) + len(b)
    shared = overlap(a, b)
    return bool(n) and 100 * shared >= 75 * (n - shared)


def _bounded(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs whose bitmaps leave room for a link. Bitmaps have a sixteenth of the arrays' bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(2, 6)]
            keep = [may_link(*row) for row in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return arrays.select(
            F.col("doc_id").alias(name), F.col("bitmap").alias(f"of_{name}"), F.col("n").alias(f"n_{name}")
        )

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "of_a", "n_a", "of_b", "n_b").mapInArrow(tidy(run), "a long, b long")


def _needed(arrays: DataFrame, ids: DataFrame) -> DataFrame:
    """The arrays of these ids alone. As long as the ids are few they are broadcast, and no other array
    crosses the network."""
    return arrays.select("doc_id", "shingles").join(ids.distinct(), "doc_id", "left_semi")


def _in_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """The pairs that link, by the arrays of the documents in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_ascending(batch.column(i)) for i in (2, 3))
            keep = [similar(x, y) for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return arrays.select(F.col("doc_id").alias(name), F.col("shingles").alias(f"of_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "of_a", "of_b").mapInArrow(tidy(run), "a long, b long")


def _ascending(lists: pa.ListArray) -> Iterator[np.ndarray]:
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
    bounds = lists.offsets.to_numpy()
    return (values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))


def _bitmap(shingles: np.ndarray, words: int) -> np.ndarray:
    bits = np.zeros(words * 64, np.uint8)
    bits[(shingles & np.uint64(words * 64 - 1)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def cell_links(
    sets: list[np.ndarray], group: np.ndarray, side: np.ndarray, early: np.ndarray, home: np.ndarray
) -> list[tuple[int, int]]:
    """Links that connect what a cell of a tile connects.

    ``group`` is what a member is connected with already. Members of ``side`` 0 and 1 are compared
    with each other; a cell with one side has -1 throughout and compares all. The shorter of a pair
    is at home in the tile's band and has its shingle among its early ones.
    """
    size = np.array([len(x) for x in sets])
    words = 1 << max(int(16 * size[home].max(initial=1) - 1).bit_length() - 6, 0)
    bitmaps = np.stack([_bitmap(x, words) for x in sets])
    order = np.lexsort((np.arange(len(sets)), ~home, size))
    group = np.unique(group, return_inverse=True)[1]
    links = []
    for place, x in enumerate(order):
        if not (home[x] and early[x]):
            continue
        others = order[place + 1 :]
        near = 3 * size[others] <= 4 * size[x]
        near &= (side[others] != side[x]) | (side[x] < 0)
        others = others[near & (group[others] != group[x])]
        if not len(others):
            continue
        only_x = np.bitwise_count(bitmaps[x] & ~bitmaps[others]).sum(axis=1, dtype=np.int64)
        only_y = np.bitwise_count(bitmaps[others] & ~bitmaps[x]).sum(axis=1, dtype=np.int64)
        bound = np.minimum(size[x] - only_x, size[others] - only_y)
        total = size[x] + size[others]
        for y in others[100 * bound >= 75 * (total - bound)]:
            if group[x] != group[y] and similar(sets[x], sets[y]):
                links.append((x, y))
                group[group == group[y]] = group[x]
    return links


def partnered(
    size: np.ndarray, group: np.ndarray, early: np.ndarray, home: np.ndarray
) -> np.ndarray:
    """Which members of a tile have another one, not connected yet, whose size lets them link."""
    order = np.lexsort((~(home & early), size))
    size, group, shorter = size[order], group[order], (home & early)[order]
    until = np.searchsorted(size, 4 * size // 3, "right")
    keep = np.zeros(len(size), bool)
    for i in np.flatnonzero(shorter):
        others = slice(i + 1, until[i])
        apart = group[others] != group[i]
        keep[others] |= apart
        keep[i] |= apart.any()
    found = np.zeros(len(size), bool)
    found[order] = keep
    return found


def _partnered(members: DataFrame) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        columns = (
            rows.column(name).to_numpy() for name in ("n", "group", "early", "home")
        )
        return rows.filter(pa.array(partnered(*columns)))

    return members.groupBy("tile").applyInArrow(run, members.schema)


def _compared(members: DataFrame) -> DataFrame:
    """The full comparison of ``members(tile, cell_i, cell_j, block, doc_id, ...)``, cell by cell."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(x, np.int64).view(np.uint64) for x in rows["shingles"]]
        one = rows["cell_i"].iloc[0] == rows["cell_j"].iloc[0]
        side = np.full(len(rows), -1) if one else rows["block"].to_numpy() == rows["cell_i"].iloc[0]
        group, early, home = (rows[c].to_numpy() for c in ("group", "early", "home"))
        found = cell_links(sets, group, side.astype(int), early.astype(bool), home.astype(bool))
        ids = rows["doc_id"].to_numpy()
        return pd.DataFrame({"a": [ids[x] for x, _ in found], "b": [ids[y] for _, y in found]})

    return members.groupBy("tile", "cell_i", "cell_j").applyInPandas(run, "a long, b long")


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document row ``doc_id, n_shingles, component_id``: the size of its set, and the smallest
    id that links reach from it, its own included.

    Words are what lies between white space, with A-Z in lower case. A document of fewer than five
    words has all of them as its one shingle. Null and empty texts have no shingles and no links.
    Repeated rows link like copies, and rows of one id with different texts share a component. A row
    without an id is not linked and has no component. Other columns are not read; a table without
    rows gives none.
    """
    spark = documents.sparkSession
    folder = scratch_dir(spark, "jaccard")

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    sets = written(_sets(texts), "sets")
    looked_up = sets.where("counts IS NULL").drop("counts")
    keyed = looked_up.where("n > 0 AND doc_id IS NOT NULL")
    classes = written(
        keyed.groupBy("class_a", "class_b", "n").agg(F.min("doc_id").alias("doc_id")), "classes"
    )
    ranges = RANGES_PER_PARTITION * max(texts.rdd.getNumPartitions(), 1)
    standing = _standing(_entries(texts.where("doc_id IS NOT NULL"), _counts(sets), ranges))
    members = written(_members(standing.join(classes, "class_a")), "members")
    arrays = written(_arrays(texts, members.select("doc_id").distinct()), "arrays")

    stars = members.where("doc_id <> first AND 3 * n <= 4 * first_n AND 3 * first_n <= 4 * n")
    stars = stars.select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = written(stars, "stars")
    near_stars = written(_bounded(stars, arrays), "near_stars")
    of_stars = written(_needed(arrays, _in_pairs(near_stars)), "star_arrays")
    star_links = written(_verified(near_stars, of_stars), "star_links")
    apart = written(_apart(members, star_links), "apart")
    pairs = written(_bounded(_pairs(apart).join(stars, ["a", "b"], "left_anti"), arrays), "near_pairs")
    of_pairs = written(_needed(arrays, _in_pairs(pairs)), "pair_arrays")
    pair_links = written(_verified(pairs, of_pairs), "pair_links")
    cells = written(_cells(apart), "cell_members")
    of_cells = _needed(arrays, cells.select("doc_id"))
    cell_links = written(_compared(cells.join(of_cells, "doc_id")), "cells")
    links = star_links.unionByName(pair_links).unionByName(cell_links)
    named = classes.select(
        F.col("doc_id").alias("node"), "class_a", "class_b"
    ).join(components(links.unionByName(_same_id(keyed, classes))), "node", "left")
    known = named.select(
        "class_a", "class_b", F.coalesce("component", "node").alias("component")
    )
    # Rows without a set have a class of their own, the empty one, that no representative is in.
    return looked_up.join(known, ["class_a", "class_b"], "left").select(
        F.col("doc_id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias(
            "component_id"
        ),
    )


def _same_id(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes that rows of one repeated id fall into."""
    repeated = keyed.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    rows = keyed.select("doc_id", "class_a", "class_b").join(repeated, "doc_id", "left_semi")
    named = rows.join(
        classes.withColumnRenamed("doc_id", "node"), ["class_a", "class_b"]
    )
    return named.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()


def _members(standing: DataFrame) -> DataFrame:
    """The representatives in every tile that can hold a link, tiles of the same documents once.

    ``first`` is the tile's smallest document id and ``rows`` how many documents it has.
    """
    tile = Window.partitionBy("tile")
    named = standing.withColumns(
        {
            "rows": F.count("*").over(tile),
            "same": F.bit_xor(F.xxhash64("doc_id", "home")).over(tile),
            "lead": F.min(F.struct("doc_id", "n")).over(tile),
        }
    ).select(
        F.col("same").alias("tile"),
        "rows",
        "doc_id",
        "n",
        "home",
        "early",
        F.col("lead.doc_id").alias("first"),
        F.col("lead.n").alias("first_n"),
    )
    return named.groupBy("tile", "rows", "doc_id", "n", "home", "first", "first_n").agg(
        F.max("early").alias("early")
    )


def _apart(members: DataFrame, star_links: DataFrame) -> DataFrame:
    """The members of tiles that are not connected through their first one, as far as their sizes let
    them link. ``left`` is how many of a tile there are."""
    labels = components(star_links)
    tile = Window.partitionBy("tile")
    apart = (
        members.where("rows > 2")
        .join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("group", F.coalesce("component", "doc_id"))
        .withColumns({"lowest": F.min("group").over(tile), "highest": F.max("group").over(tile)})
        .where("lowest <> highest")
        .select("tile", "doc_id", "n", "group", "early", "home")
    )
    return _partnered(apart).withColumn("left", F.count("*").over(tile))


def _pairs(apart: DataFrame) -> DataFrame:
    """The pairs of small tiles. Documents share many tiles with nearly the same members, so their
    pairs are much fewer than the tiles' members; a tile gives a bounded number of them."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("doc_id").to_numpy()
        size, group, early, home = (
            rows.column(name).to_numpy() for name in ("n", "group", "early", "home")
        )
        pairs = [
            (min(ids[i], ids[j]), max(ids[i], ids[j]))
            for i in np.flatnonzero(home & early)
            for j in range(len(ids))
            if group[i] != group[j] and 3 * size[i] <= 3 * size[j] <= 4 * size[i]
        ]
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    small = apart.where(F.col("left") <= SMALL_TILE)
    return small.groupBy("tile").applyInArrow(run, "a long, b long").distinct()


def _cells(apart: DataFrame) -> DataFrame:
    """The larger tiles, cut into pairs of blocks of bounded size."""
    tile = Window.partitionBy("tile")
    blocked = (
        apart.where(F.col("left") > SMALL_TILE)
        .withColumn("weight", F.sum("n").over(tile))
        .withColumn("blocks", F.ceil(F.col("weight") / CELL_SHINGLES).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return blocked.select("*", other.alias("other")).select(
        "tile",
        F.least("block", "other").alias("cell_i"),
        F.greatest("block", "other").alias("cell_j"),
        "block",
        "doc_id",
        "group",
        "early",
        "home",
    )


def deduplicated(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns.

    Of several rows with that id, the one whose text and then other columns come first stays. Rows
    without an id stay.
    """
    spark = documents.sparkSession
    folder = scratch_dir(spark, "deduplicated")

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    found = written(near_duplicates(documents, id_column, text_column), "components")
    own = F.col(id_column)
    # Written, so that its size is known when the join is planned: as long as it is small, the texts
    # are not shuffled.
    copies = written(found.where(F.col("component_id") != own).select(id_column).distinct(), "copies")
    kept = documents.join(copies, id_column, "left_anti")
    again = found.where(own.isNotNull()).groupBy(id_column).agg(F.count("*").alias("_rows")).where("_rows > 1")
    if again.isEmpty():
        return kept
    # Only rows of repeated ids are compared, and of those each task hands on one a key.
    repeated = again.select(id_column)
    rest = [c for c in sorted(documents.columns) if c not in (id_column, text_column)]
    order = Window.partitionBy(id_column).orderBy(text_column, *rest)
    first = kept.join(repeated, id_column, "left_semi").withColumn("_place", F.row_number().over(order))
    single = kept.join(repeated, id_column, "left_anti")
    return single.unionByName(first.where("_place = 1").drop("_place")).select(*documents.columns)
