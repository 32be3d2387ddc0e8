"""SimHash fingerprints of word shingles, and near fingerprints by BK-trees.

A BK-tree hangs every fingerprint below another one, as the child named by their Hamming distance.
What lies within ``radius`` of a query that is ``d`` away from a node is below the children
``d - radius`` to ``d + radius`` only, so a search follows just those edges.

One tree over all fingerprints would have to go whole to every task, and near its root a search of it
follows nearly every edge. So the 64 bits are cut into pieces: two fingerprints that differ in at
most ``radius`` bits agree on all but ``radius`` pieces. Every choice of the pieces that agree, with
its bits, names a shard with a tree of its own, which meets just the members of the shard as queries.
Shards of more than 4,096 fingerprints are not searched: their members are dealt again by more and smaller
pieces. At the last level only ``3 * 4`` bits of a shard are free, so it cannot have more.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.components import components
from shopmarts.session import scratch_dir

SHINGLE = 3
SEED = 42
RADIUS = 3
LEVELS = (5, 8, 16)  # pieces of the 64 bits
SHARD = 4_096  # fingerprints searched by one tree
SLICE = 1 << 20  # bytes of a text that are cut into words at once
FRONTIER = 1 << 21  # pairs of a query and a node that are compared at once

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        found = _SPACE.search(data, at + SLICE) if at + SLICE < len(data) else None
        end = found.start() if found else len(data)
        yield data[at:end].split()
        at = end


def _counts(words: list[bytes], size: int) -> np.ndarray:
    """How many shingle hashes have each bit, and at last how many hashes there are."""
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate([[0], end[:-1] + 1])
    spans = zip(start[: len(words) - size + 1].tolist(), end[size - 1 :].tolist())
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in spans], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.append(bits.sum(axis=0, dtype=np.int64), len(hashes))


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bits set in over half the hashes of the shingles of ``size`` words, A-Z in lower case, repeats
    included. Fewer words are one shingle; no words, or null, give 0."""
    total = np.zeros(65, np.int64)
    tail: list[bytes] = []
    for some in _words((text or b"").lower()):
        tail += some
        if len(tail) >= size:
            total += _counts(tail, size)
            tail = tail[len(tail) - size + 1 :]
    if not total[64] and tail:
        total = _counts(tail, len(tail))
    bits = (2 * total[:64] > total[64]).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SHINGLE
) -> DataFrame:
    """``id_column, print`` for every row; ``print`` is the fingerprint as a signed long."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(text.as_py(), size) for text in batch.column(1))
            prints = np.fromiter(found, np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=[id_column, "print"])

    texts = documents.select(F.col(id_column), F.col(text_column).cast("string").cast("binary"))
    kind = documents.schema[id_column].dataType.simpleString()
    return texts.mapInArrow(made, f"`{id_column}` {kind}, print long")


class BKForest:
    """A BK-tree for every run of equal ``shard`` values; the values of a shard are distinct."""

    def __init__(self, values: np.ndarray, shard: np.ndarray) -> None:
        self.values = values
        rows = np.arange(len(values))
        first = np.concatenate([[True], shard[1:] != shard[:-1]])
        self.root = np.maximum.accumulate(np.where(first, rows, 0))
        self.size = np.diff(np.append(np.flatnonzero(first), len(values)))[np.cumsum(first) - 1]
        keys, nodes = [], []
        waiting, above = rows[~first], self.root[~first]
        while len(waiting):
            # Of all that come to the same edge of a node, the first becomes the child there.
            edge = above * 65 + np.bitwise_count(values[waiting] ^ values[above])
            key, child, group = np.unique(edge, return_index=True, return_inverse=True)
            keys.append(key)
            nodes.append(waiting[child])
            below = np.ones(len(waiting), bool)
            below[child] = False
            waiting, above = waiting[below], waiting[child][group[below]]
        key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        node = np.concatenate(nodes) if nodes else np.zeros(0, np.int64)
        order = np.argsort(key)
        self.key, self.node = key[order], node[order]

    def near(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query row and another row of its shard at most ``radius`` away."""
        asked, at = queries, self.root[queries]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(asked):
            far = np.bitwise_count(self.values[asked] ^ self.values[at]).astype(np.int64)
            hit = (far <= radius) & (asked != at)
            found.append((asked[hit], at[hit]))
            low = np.searchsorted(self.key, at * 65 + np.maximum(far - radius, 0), "left")
            high = np.searchsorted(self.key, at * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            begin = np.repeat(low - np.cumsum(count) + count, count)
            asked, at = np.repeat(asked, count), self.node[begin + np.arange(len(begin))]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])

    def joined(self, radius: int) -> np.ndarray:
        """For every row the first row of its shard that links connect it with."""
        label = np.arange(len(self.values))
        total = np.concatenate([[0], np.cumsum(self.size)])
        at = 0
        while at < len(self.values):
            until = max(int(np.searchsorted(total, total[at] + FRONTIER, "right")) - 1, at + 1)
            a, b = self.near(np.arange(at, until), radius)
            while True:
                low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
                apart = low < high
                if not apart.any():
                    break
                np.minimum.at(label, high[apart], low[apart])
                while (label != label[label]).any():
                    label = label[label]
            at = until
        return label


def _linker(radius: int):
    def linked(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        pieces, kept = (rows[c].to_numpy() for c in ("pieces", "kept"))
        change = (pieces[1:] != pieces[:-1]) | (kept[1:] != kept[:-1])
        shard = np.concatenate([[0], np.cumsum(change)])
        many = np.bincount(shard)[shard] > 1
        values = rows["print"].to_numpy()[many]
        if not len(values):
            return
        label = BKForest(values.view(np.uint64), shard[many]).joined(radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(values[moved]), pa.array(values[label[moved]])], names=["a", "b"])

    def linker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; one that goes on in the next batch waits for it."""
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            last = [held[c][-1].as_py() for c in ("pieces", "kept")]
            own = (held["pieces"].to_numpy() == last[0]) & (held["kept"].to_numpy() == last[1])
            begin = len(own) - int(own.sum())
            if begin:
                yield from linked(held.slice(0, begin).combine_chunks())
                held = held.slice(begin)
        if held is not None:
            yield from linked(held.combine_chunks())

    return linker


def masks(pieces: int, radius: int) -> list[int]:
    """The bits of every choice of ``pieces - radius`` pieces, as signed longs."""
    bounds = [64 * i // pieces for i in range(pieces + 1)]
    own = [(1 << high) - (1 << low) for low, high in zip(bounds, bounds[1:])]
    found = [sum(choice) for choice in combinations(own, pieces - radius)]
    return [mask - (1 << 64) if mask >> 63 else mask for mask in found]


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that connect exactly the distinct ``print`` values which chains of steps of at
    most ``radius`` bits connect. Per shard they are a forest, not all pairs."""
    if radius >= min(LEVELS):
        raise ValueError(f"radius must be below {min(LEVELS)}")
    spark = prints.sparkSession
    folder = scratch_dir(spark, "simhash-links")
    found: DataFrame | None = None
    rest = prints.select("print").where("print IS NOT NULL").distinct()
    for level, pieces in enumerate(LEVELS):
        choices = F.array(*[F.lit(mask) for mask in masks(pieces, radius)])
        path = os.path.join(folder, f"shards-{level}")
        dealt = rest.select(F.posexplode(choices).alias("pieces", "mask"), "print")
        dealt = dealt.select("pieces", F.col("mask").bitwiseAND(F.col("print")).alias("kept"), "print")
        last = level == len(LEVELS) - 1
        if not last:
            dealt.write.parquet(path)
            dealt = spark.read.parquet(path)
            large = dealt.groupBy("pieces", "kept").count().where(F.col("count") > SHARD)
            large.write.parquet(f"{path}-large")
            large = spark.read.parquet(f"{path}-large").drop("count")
            more = not large.isEmpty()
            if more:
                rest = dealt.join(large, ["pieces", "kept"], "left_semi").select("print").distinct()
                rest.write.parquet(f"{path}-rest")
                rest = spark.read.parquet(f"{path}-rest")
                dealt = dealt.join(large, ["pieces", "kept"], "left_anti")
        ordered = dealt.repartition("pieces", "kept").sortWithinPartitions("pieces", "kept", "print")
        links = ordered.mapInArrow(_linker(radius), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if last or not more:
            break
    return found


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``id_column, fingerprint, component_id`` for every row, repeated rows and null ids included.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id that
    links reach, null only where all of them are null. Texts without words have the fingerprint zero
    and link like any other.
    """
    spark = documents.sparkSession
    path = os.path.join(scratch_dir(spark, "simhash"), "prints")
    fingerprints(documents, id_column, text_column).write.parquet(path)
    prints = spark.read.parquet(path)
    own = prints.groupBy("print").agg(F.min(id_column).alias("least"))
    reached = components(near_links(own, radius)).withColumnRenamed("node", "print")
    grouped = own.join(reached, "print", "left").withColumn("root", F.coalesce("component", "print"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(least, "root").select("print", "component_id")
    return prints.join(named, "print").select(
        id_column, F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
