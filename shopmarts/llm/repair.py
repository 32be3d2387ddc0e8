"""Token ids in Re-Pair compressed shard files with random access to every document.

A shard is a block of whole documents in ascending id order with a grammar of its own: again and
again its frequent neighbouring pairs become new symbols, whose rules and expansion lengths are
stored. No pair reaches over the end of a document, so a document is a run of symbols and is
decoded alone. One task writes the shards of its id range into files of a few shards each.

One shard, all integers little-endian::

    "RPR1", u32 n_docs, u32 n_rules, u64 n_symbols, u64 n_ids, u32 base, u32 crc32 of what follows
    i64 doc_id[n_docs]            ascending
    u64 symbol_start[n_docs + 1]  where a document's symbols begin
    u64 id_start[n_docs + 1]      where its ids begin, counted from the shard's first
    u32 left[n_rules], right[n_rules]   symbol base + r stands for left[r] right[r]
    u32 length[n_rules]           how many ids it expands to
    u24 symbol[n_symbols]
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmarts.llm.files import put
from shopmarts.llm.memory import tidy
from shopmarts.llm.tokenizing import TEXT_BYTES, encoder
from shopmarts.llm.words import blocks

MAGIC = b"RPR1"
HEAD = struct.Struct("<4sIIQQII")
NAME = re.compile(r"shard-(\d+)-(\d+)\.rpr$")
SYMBOLS = 1 << 24
BUCKETS = 18  # bits of the table that finds frequent pairs

DECODED = "doc_id long, part int, file int, at long, n_tokens long, ids_crc32 long"


class BadShard(ValueError):
    """A shard file that is cut off or changed."""


@dataclass(frozen=True)
class Grammar:
    base: int
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray


def compress(ids: np.ndarray, ends: np.ndarray, least: int = 8) -> tuple:
    """The grammar, the symbols, and where each document's symbols end.

    ``ends`` holds the positions of the documents' last ids. Each round counts all neighbouring pairs,
    first in a hashed table and then exactly, and replaces those that occur ``least`` times without
    overlaps. Where two of them overlap, the more frequent one is taken, so the most frequent pair of
    all is replaced wherever it stands; rounds go on until no pair is frequent enough. If symbols run
    out, the most frequent pairs get the last ones.
    """
    symbols = ids.astype(np.int32)  # less than 2^24
    last = np.zeros(len(ids), bool)
    last[ends] = True
    base = int(ids.max(initial=0)) + 1
    left, right, length = [], [], np.ones(base, np.int64)
    # A replaced pair leaves a gap, so a round only touches the places that changed.
    after = np.arange(1, len(ids) + 1)
    before = np.arange(-1, len(ids))
    stands = np.ones(len(ids), bool)
    at = np.flatnonzero(_maybe_often(symbols[:-1], symbols[1:], least) & ~last[:-1])
    while len(at):
        key = symbols.take(at).astype(np.int64) << 24
        key |= symbols.take(after.take(at))
        twins = np.flatnonzero(key >> 24 == key & (SYMBOLS - 1))
        own = at[twins]
        lone = np.ones(len(at), bool)
        lone[twins] = _every_other(after[own[:-1]] == own[1:], len(own))
        pairs, which, seen = _numbered(np.compress(lone, key))
        frequent = seen >= least
        # What is rare now never gets frequent: an old pair only loses places.
        kept = np.flatnonzero(frequent.take(which))
        twice = at[np.flatnonzero(~lone)]
        asked = at = at.take(np.flatnonzero(lone)).take(kept)
        which = which.take(kept)
        rank = np.empty(len(pairs), np.int64)
        some = np.flatnonzero(frequent)
        rank[some[np.argsort(seen[some], kind="stable")]] = np.arange(len(some))
        own, touch = rank.take(which), after.take(at[:-1]) == at[1:]
        stays = np.ones(len(at), bool)
        stays[:-1] &= ~(touch & (own[1:] > own[:-1]))
        stays[1:] &= ~(touch & (own[:-1] > own[1:]))
        stays = np.flatnonzero(stays)
        at, which = at.take(stays), which.take(stays)
        seen = np.bincount(which, minlength=len(pairs))
        chosen = np.flatnonzero(seen >= least)
        chosen = np.sort(chosen[np.argsort(-seen[chosen], kind="stable")[: SYMBOLS - len(length)]])
        if not len(chosen):
            break
        number = np.full(len(pairs), -1, np.int32)
        number[chosen] = np.arange(len(chosen)) + len(length)
        fresh = number.take(which)
        stays = np.flatnonzero(fresh >= 0)
        at, fresh = at.take(stays), fresh.take(stays)
        left.append(pairs[chosen] >> 24)
        right.append(pairs[chosen] & (SYMBOLS - 1))
        length = np.concatenate([length, length[left[-1]] + length[right[-1]]])
        gone = after.take(at)
        symbols[at] = fresh
        last[at] = last.take(gone)
        stands[gone] = False
        then = after.take(gone)
        after[at] = then
        before[then] = at
        # Next come the pairs with a new symbol, and those that may be frequent and were not replaced.
        again = np.zeros(len(symbols), bool)
        again[asked] = again[twice] = again[at] = True
        earlier = before.take(at)
        again[earlier[np.flatnonzero(earlier >= 0)]] = True
        at = np.flatnonzero(again & stands & ~last)
        at = at.take(np.flatnonzero(_maybe_often(symbols.take(at), symbols.take(after.take(at)), least)))
    none = np.zeros(0, np.int64)
    grammar = Grammar(
        base,
        np.concatenate([none, *left]),
        np.concatenate([none, *right]),
        length[base:],
    )
    return grammar, symbols[stands], np.flatnonzero(last[stands])


def _maybe_often(first: np.ndarray, second: np.ndarray, least: int) -> np.ndarray:
    """Whether each pair may occur ``least`` times: in a hashed table its bucket does."""
    mixed = first.view(np.uint32) * np.uint32(0x9E3779B1)
    mixed ^= mixed >> np.uint32(15)
    mixed += second.view(np.uint32)
    mixed *= np.uint32(0x85EBCA77)
    mixed >>= np.uint32(32 - BUCKETS)
    bucket = mixed.astype(np.int64)
    return (np.bincount(bucket, minlength=1 << BUCKETS) >= least).take(bucket)


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, each key's number among them, and how often each occurs.
    Arrow finds them by hashing, so only the distinct ones are sorted."""
    coded = pc.dictionary_encode(pa.array(key), memory_pool=pa.system_memory_pool())
    distinct = coded.dictionary.to_numpy()
    order = np.argsort(distinct)
    place = np.empty(len(distinct), np.int64)
    place[order] = np.arange(len(distinct))
    which = place[coded.indices.to_numpy()]
    return distinct[order], which, np.bincount(which, minlength=len(distinct))


def _every_other(joined: np.ndarray, count: int) -> np.ndarray:
    """Of ``count`` places in ascending order, those that do not overlap the one taken before them.
    ``joined`` tells of every place but the last whether the next one overlaps it."""
    if not count:
        return np.zeros(0, bool)
    begins = np.concatenate([[True], ~joined])
    order = np.arange(count)
    first = np.maximum.accumulate(np.where(begins, order, 0))
    return (order - first) % 2 == 0


def expand(symbols: np.ndarray, grammar: Grammar) -> np.ndarray:
    """The ids that the symbols stand for. A rule only uses symbols older than its own."""
    left = np.concatenate([np.arange(grammar.base), grammar.left])
    right = np.concatenate([np.full(grammar.base, -1), grammar.right])
    while len(symbols) and symbols.max() >= grammar.base:
        ruled = symbols >= grammar.base
        place = np.cumsum(1 + ruled) - 1 - ruled
        wider = np.empty(len(symbols) + int(ruled.sum()), np.int64)
        wider[place] = left[symbols]
        wider[place[ruled] + 1] = right[symbols[ruled]]
        symbols = wider
    return symbols


def shard(doc_ids: list[int], encoded: list[bytes]) -> bytes:
    """One shard of documents; every document has at least one id."""
    counts = np.array([len(x) // 4 for x in encoded])
    id_start = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
    ids = np.frombuffer(b"".join(encoded), "<u4")
    grammar, symbols, ends = compress(ids, id_start[1:].astype(np.int64) - 1)
    symbol_start = np.concatenate([[0], ends + 1]).astype("<u8")
    rules = [x.astype("<u4").tobytes() for x in (grammar.left, grammar.right, grammar.length)]
    packed = symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    body = b"".join(
        [np.array(doc_ids, "<i8").tobytes(), symbol_start.tobytes(), id_start.tobytes(), *rules, packed]
    )
    head = (len(doc_ids), len(grammar.left), len(symbols), len(ids), grammar.base, zlib.crc32(body))
    return HEAD.pack(MAGIC, *head) + body


class Shard:
    """An open shard: documents are decoded one by one or all at once."""

    def __init__(self, content: memoryview) -> None:
        if len(content) < HEAD.size:
            raise BadShard("a shard is cut off")
        magic, docs, rules, symbols, self.n_ids, base, crc = HEAD.unpack_from(content)
        if magic != MAGIC:
            raise BadShard("not a shard")
        self.size = HEAD.size + 8 * docs + 16 * (docs + 1) + 12 * rules + 3 * symbols
        body = content[HEAD.size : self.size]
        if len(content) < self.size or zlib.crc32(body) != crc:
            raise BadShard("a shard is cut off or changed")
        at = 0

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, count, at)
            at += found.nbytes
            return found.astype(np.int64)

        self.doc_ids = take("<i8", docs)
        self.symbol_start = take("<u8", docs + 1)
        self.id_start = take("<u8", docs + 1)
        self.grammar = Grammar(base, *(take("<u4", rules) for _ in range(3)))
        raw = np.frombuffer(body, np.uint8, 3 * symbols, at).reshape(-1, 3)
        wide = np.zeros((symbols, 4), np.uint8)
        wide[:, :3] = raw
        self.symbols = wide.reshape(-1).view("<u4").astype(np.int64)

    def document(self, index: int) -> np.ndarray:
        """The ids of one document; no other is expanded."""
        run = self.symbols[self.symbol_start[index] : self.symbol_start[index + 1]]
        return expand(run, self.grammar).astype("<u4")

    def ids(self) -> np.ndarray:
        """The ids of all documents: each distinct symbol is expanded once."""
        grammar, symbols = self.grammar, self.symbols
        length = np.concatenate([np.ones(grammar.base, np.int64), grammar.length])
        used = np.zeros(len(length), bool)
        used[symbols] = True
        distinct = np.flatnonzero(used)
        stored = expand(distinct, grammar).astype("<u4")
        start = np.cumsum(np.where(used, length, 0)) - length
        count = length[symbols]
        ends = np.cumsum(count)
        if length[distinct].sum() != len(stored) or count.sum() != self.n_ids:
            raise BadShard("a shard's rules do not give its ids")
        shift = np.repeat(start[symbols] - ends + count, count)
        return stored[shift + np.arange(self.n_ids)]


def shards_of(content: bytes) -> Iterator[Shard]:
    """The shards of one file, one at a time."""
    rest = memoryview(content)
    while len(rest):
        found = Shard(rest)
        yield found
        rest = rest[found.size :]


def write_shards(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    end_id: int = 2,
    shard_tokens: int = 1_000_000,
    shards_per_file: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode all documents into shard files below ``folder``; return one row per file.

    Documents are dealt by ranges of their id and sorted, so file names ascend with the ids. A null
    or empty text is the end id alone; repeated rows are stored once each, in an order settled by
    the text. Rows without an id come first, under id -2^63. A table without rows makes no file.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        names: list[int] = []
        ids: list[bytes] = []
        ready: list[bytes] = []
        held = docs = tokens = files = 0

        def close_shard() -> None:
            nonlocal held, docs, tokens
            docs, tokens, held = docs + len(names), tokens + held, 0
            ready.append(shard(names, ids))
            names.clear()
            ids.clear()

        def close_file() -> pa.RecordBatch:
            nonlocal files, docs, tokens
            put(f"{folder}/shard-{part:07d}-{files:07d}.rpr", b"".join(ready))
            row = {"part": part, "file": files, "n_docs": docs, "n_ids": tokens}
            row["n_bytes"] = sum(map(len, ready))
            files, docs, tokens = files + 1, 0, 0
            ready.clear()
            return pa.RecordBatch.from_pylist([row], MANIFEST)

        for batch in batches:
            for at, texts in blocks(batch.column(1), TEXT_BYTES):
                found = coder.encode(texts)
                own = batch.column(0).slice(at, len(texts)).to_pylist()
                for name, x in zip(own, found, strict=True):
                    names.append(-(1 << 63) if name is None else name)
                    ids.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= shard_tokens:
                        close_shard()
                        if len(ready) == shards_per_file:
                            yield close_file()
        if ids:
            close_shard()
        if ready:
            yield close_file()

    ordered = (
        documents.select(id_column, text_column)
        .repartitionByRange(id_column)
        .sortWithinPartitions(id_column, text_column)
    )
    manifest = f"{folder}/manifest"
    rows = ordered.mapInArrow(tidy(run), "part int, file int, n_docs long, n_ids long, n_bytes long")
    rows.write.mode("overwrite").parquet(manifest)
    return documents.sparkSession.read.parquet(manifest)


MANIFEST = pa.schema(
    [("part", pa.int32()), ("file", pa.int32())]
    + [(name, pa.int64()) for name in ("n_docs", "n_ids", "n_bytes")]
)
ROWS = pa.schema(
    [("doc_id", pa.int64()), ("part", pa.int32()), ("file", pa.int32())]
    + [(name, pa.int64()) for name in ("at", "n_tokens", "ids_crc32")]
)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document, from the files alone: its id, file, place there and checksum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                part, file = map(int, NAME.search(path.as_py()).groups())
                at = 0
                for found in shards_of(content.as_buffer()):
                    starts, ids = found.id_start, memoryview(found.ids()).cast("B")
                    rows = len(found.doc_ids)
                    crc = [
                        zlib.crc32(ids[4 * a : 4 * b])
                        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)
                    ]
                    yield pa.record_batch(
                        [
                            pa.array(found.doc_ids),
                            pa.array(np.full(rows, part, np.int32)),
                            pa.array(np.full(rows, file, np.int32)),
                            pa.array(starts[:-1] + at),
                            pa.array(np.diff(starts)),
                            pa.array(crc, pa.int64()),
                        ],
                        schema=ROWS,
                    )
                    at += found.n_ids

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.rpr").load(folder)
    return files.select("path", "content").mapInArrow(run, DECODED)


def stored_documents(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``read_shards`` with the number of ids that all files before a document's hold."""
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select(
        "part", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")
    )
    return (
        read_shards(spark, folder)
        .join(starts, ["part", "file"])
        .select(
            "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
        )
    )
