"""Stupid-backoff language-model scores of documents, from n-gram counts over all of them.

A word's score is its n-gram's count over the count of the n-gram without the word; if fewer than
``least`` such n-grams are in the corpus, it is ``backoff`` times the score by the shorter n-gram, and at
last the word's share of all words. The score of a document is the sum of the logarithms.

The counts are tables partitioned by the n-gram's hash, and the join is made by blocks, runs of documents
of a bounded number of words:

1. Each block lists its different n-grams with their counts in it, as packed arrays of ascending hashes,
   cut into ranges of hashes. A word that is in every document is one entry per block.
2. Each range adds up the counts of all blocks, and answers each block with the totals of the n-grams
   that it asked for, in the same order and without their hashes. An n-gram below ``least`` has none.
3. A block's answers are stored as one file in the shared folder. The block is read again, its n-grams are
   put in order again, and the logarithms are summed per document.

Memory is bounded by a block's and a range's n-grams; how many ranges there are follows from the size of all
texts. Blocks and ranges without a common n-gram exchange nothing, so an n-gram is moved once for each
block that it is in, and its total, mostly one byte, twice. Words are what lies between white space, with
A-Z in lower case; n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.files import put
from shopmarts.llm.memory import tidy
from shopmarts.llm.words import NOT_SPACE, blocks, find_words, shingle_hashes
from shopmarts.session import scratch_dir

BLOCK_WORDS = 2_500_000  # of a block, or one document; its hashes take 20 MB for each length of n-gram
RANGE_BYTES = 8 << 20  # of text, for each length of n-gram: seldom more than two million n-grams
ASKED = pa.schema(
    [("range", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("hashes", pa.binary())]
    + [("counts", pa.binary())]
)
ASKED_SQL = "range long, block long, n int, hashes binary, counts binary"
ANSWERS = pa.schema(
    [("range", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("grams", pa.int64())]
    + [("check", pa.int64()), ("totals", pa.binary()), ("words", pa.int64())]
)
ANSWERS_SQL = "range long, block long, n int, grams long, check long, totals binary, words long"


class ChangedInput(RuntimeError):
    """The documents of a block were others when it was read again."""


def _grams(texts: pa.Array, order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Words per text; per n up to ``order`` the hashes of all n-grams, each within one text, and the
    number of the word that each ends with."""
    found = find_words(texts, NOT_SPACE)
    text_of = np.repeat(np.arange(len(texts)), found.counts)
    hashes, ends = [], []
    for n in range(1, order + 1):
        all_ = shingle_hashes(found.hash, n)
        at = np.flatnonzero(text_of[: len(all_)] == text_of[n - 1 : n - 1 + len(all_)])
        hashes.append(all_[at])
        ends.append(at + n - 1)
    return found.counts, hashes, ends


@dataclass(frozen=True)
class Block:
    """Consecutive documents: their ids, words per document, and what ``_grams`` finds in them."""

    names: pa.Array
    words: np.ndarray
    hashes: list[np.ndarray]
    ends: list[np.ndarray]


def _runs(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[Block]:
    """The documents of a partition as blocks; the same ones whenever the partition is the same."""
    held: list[Block] = []
    words = 0

    def block() -> Block:
        hashes = [np.concatenate([x.hashes[n] for x in held]) for n in range(order)]
        before = np.cumsum([0, *(int(x.words.sum()) for x in held)])
        ends = [
            np.concatenate([x.ends[n] + at for x, at in zip(held, before[:-1], strict=True)])
            for n in range(order)
        ]
        names = pa.concat_arrays([x.names for x in held])
        return Block(names, np.concatenate([x.words for x in held]), hashes, ends)

    for batch in batches:
        for at, texts in blocks(batch.column(1), 8 << 20):
            counts, hashes, ends = _grams(texts, order)
            own = int(counts.sum())
            if held and words + own > BLOCK_WORDS:
                yield block()
                held, words = [], 0
            held.append(Block(batch.column(0).slice(at, len(texts)), counts, hashes, ends))
            words += own
    if held:
        yield block()


def _merged(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending different hashes and the sums of their counts."""
    joint, weights = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(joint)
    joint, weights = joint[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], joint[1:] != joint[:-1]])[: len(joint)])
    return joint[first], np.add.reduceat(weights, first) if len(first) else weights


def _header(count: int, width: int) -> tuple[int, int]:
    """Into how many parts a range is cut and how many bytes of a hash are left, for the fewest bytes."""
    whole = width.bit_length()
    cost = {bits: 4 * (1 << bits) + count * -(-(whole - bits) // 8) for bits in range(min(count.bit_length(), whole))}
    bits = min(cost, key=cost.get, default=0)
    return bits, whole - bits


def _packed(hashes: np.ndarray, low: int, width: int) -> bytes:
    """Ascending hashes of a range: how many there are, how many begin with each few bits, and the bytes
    of the rest."""
    bits, shift = _header(len(hashes), width)
    offset = hashes - np.uint64(low)
    first = (offset >> np.uint64(shift)).astype(np.int64) if bits else np.zeros(len(offset), np.int64)
    filled = np.bincount(first, minlength=1 << bits)
    rest = offset & np.uint64((1 << shift) - 1) if bits else offset
    used = -(-shift // 8)
    sizes = np.concatenate([[len(hashes)], filled]).astype("<u4").tobytes()
    return sizes + rest.view(np.uint8).reshape(-1, 8)[:, : min(used, 8)].tobytes()


def _unpacked(packed: pa.Buffer | bytes, low: int, width: int) -> np.ndarray:
    count = int(np.frombuffer(packed, "<u4", 1)[0])
    bits, shift = _header(count, width)
    filled = np.frombuffer(packed, "<u4", 1 << bits, 4)
    rest = np.frombuffer(packed, np.uint8, offset=4 + filled.nbytes).reshape(count, -1)
    wide = np.zeros((count, 8), np.uint8)
    wide[:, : rest.shape[1]] = rest
    found = wide.reshape(-1).view(np.uint64) + np.uint64(low)
    if bits:
        found += np.repeat(np.arange(len(filled), dtype=np.uint64) << np.uint64(shift), filled)
    return found


def _narrow(numbers: np.ndarray) -> bytes:
    """A byte for each number; those from 255 on follow in full."""
    large = numbers[numbers >= 255]
    return np.minimum(numbers, 255).astype(np.uint8).tobytes() + large.astype("<u8").tobytes()


def _wide(packed: pa.Buffer | bytes, count: int) -> np.ndarray:
    numbers = np.frombuffer(packed, np.uint8, count).astype(np.int64)
    numbers[numbers == 255] = np.frombuffer(packed, "<u8", offset=count)
    return numbers


def _check(hashes: np.ndarray) -> int:
    return int(hashes.sum(dtype=np.uint64).view(np.int64))


def _width(ranges: int) -> int:
    return (1 << 64) // ranges + 1


def _block_number(index: int) -> int:
    return TaskContext.get().partitionId() << 32 | index


def _asked(documents: DataFrame, order: int, ranges: int) -> DataFrame:
    """What each block asks for: its n-grams and their counts in it, by range of hashes."""
    width = _width(ranges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, block in enumerate(_runs(batches, order)):
            for n, own in enumerate(block.hashes, 1):
                if not len(own):
                    continue
                found, counts = np.unique(own, return_counts=True)
                place = found // np.uint64(width) if ranges > 1 else np.zeros(len(found), np.uint64)
                cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
                rows = []
                for r, part, times in zip(
                    place[np.concatenate([[0], cuts])].tolist(),
                    np.split(found, cuts),
                    np.split(counts, cuts),
                    strict=True,
                ):
                    rows.append((r, _block_number(index), n, _packed(part, r * width, width), _narrow(times)))
                columns = zip(*rows, strict=True)
                yield pa.record_batch(
                    [pa.array(x, kind) for x, kind in zip(columns, ASKED.types, strict=True)], schema=ASKED
                )

    return documents.mapInArrow(tidy(run), ASKED_SQL)


def _answers(asked: DataFrame, least: int, ranges: int) -> DataFrame:
    """The totals of one range's n-grams, for each block those that it asked for, in its order, 0 below
    ``least``. ``words`` of one row of each range is how many words the range's n-grams of one word
    stand for."""
    width = _width(ranges)

    def run(rows: pa.Table) -> pa.Table:
        made = []
        r = rows.column("range")[0].as_py()
        for n in sorted(set(rows.column("n").to_pylist())):
            own = rows.filter(pa.compute.equal(rows.column("n"), n))
            hashes = [_unpacked(x.as_buffer(), r * width, width) for x in own.column("hashes")]
            counts = [
                _wide(x.as_buffer(), len(h)) for x, h in zip(own.column("counts"), hashes, strict=True)
            ]
            joint, totals = _merged(hashes, counts)
            words = int(totals.sum()) if n == 1 else 0
            if n > 1:
                totals[totals < least] = 0
            for block, wanted in zip(own.column("block").to_pylist(), hashes, strict=True):
                told = _narrow(totals[np.searchsorted(joint, wanted)])
                made.append((r, block, n, len(wanted), _check(wanted), told, words))
                words = 0
        columns = zip(*made, strict=True)
        kinds = ANSWERS.types
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], schema=ANSWERS)

    return asked.groupBy("range").applyInArrow(run, ANSWERS_SQL)


def _stored(answers: DataFrame, folder: str) -> DataFrame:
    """An Arrow file per block with its answers. Returns what the blocks' rows say of the number of
    words."""

    def run(rows: pa.Table) -> pa.Table:
        block = rows.column("block")[0].as_py()
        with pa.BufferOutputStream() as out:
            ordered = rows.sort_by([("n", "ascending"), ("range", "ascending")])
            stored = ordered.select(["n", "grams", "check", "totals"]).combine_chunks()
            with pa.ipc.new_file(out, stored.schema) as file:
                file.write_table(stored)
            put(f"{folder}/block-{block}.arrow", out.getvalue().to_pybytes())
        words = sum(rows.column("words").to_pylist())
        return pa.table({"block": pa.array([block], pa.int64()), "words": pa.array([words])})

    return answers.groupBy("block").applyInArrow(run, "block long, words long")


def _totals(uri: str, hashes: list[np.ndarray]) -> list[np.ndarray]:
    """Per n the total of every n-gram of a block, in the order of its text."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        stored = pa.ipc.open_file(file).read_all()
    found = []
    for n, own in enumerate(hashes, 1):
        rows = stored.filter(pa.compute.equal(stored.column("n"), n))
        sizes = rows.column("grams").to_pylist()
        told = [_wide(x.as_buffer(), size) for x, size in zip(rows.column("totals"), sizes, strict=True)]
        order = np.argsort(own)
        ascending = own[order]
        first = np.ones(len(own), bool)
        first[1:] = ascending[1:] != ascending[:-1]
        check = np.array(rows.column("check").to_pylist(), np.int64).view(np.uint64).sum(dtype=np.uint64)
        if sum(sizes) != first.sum() or check != ascending[first].sum(dtype=np.uint64):
            raise ChangedInput(f"other n-grams of {n} words than were counted")
        totals = np.empty(len(own), np.int64)
        if len(own):
            totals[order] = np.concatenate(told)[np.cumsum(first) - 1]
        found.append(totals)
    return found


def _logs(
    totals: list[np.ndarray], ends: list[np.ndarray], all_words: int, backoff: float
) -> np.ndarray:
    """The logarithm of every word's score."""
    found = np.log(totals[0] / all_words)
    for n in range(2, len(totals) + 1):
        # Of the n-grams that end with a word: itself, and the one before that ends a word earlier.
        context = np.zeros(len(found), np.int64)
        context[ends[n - 2]] = totals[n - 2]
        whole = totals[n - 1]
        before = context[ends[n - 1] - 1]
        seen = (whole > 0) & (before > 0)
        shorter = found[ends[n - 1]] + np.log(backoff)
        found[ends[n - 1]] = np.where(seen, np.log(np.maximum(whole, 1) / np.maximum(before, 1)), shorter)
    return found


def scored(
    documents: DataFrame,
    order: int = 3,
    least: int = 1,
    backoff: float = 0.4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per document row ``doc_id, n_words, log_score`` (natural, the sum) and ``mean_log_score``.

    Null and empty texts have no words, a sum of 0 and no mean. Repeated rows count and are scored each.
    Other columns are not read. The first word of a document has no shorter n-gram to back off from: it
    scores its share of all words. The input must give the same partitions when it is read again, as
    files do; if a block has other n-grams the second time, the job fails.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column))
    folder = scratch_dir(spark, "ngrams")
    size = texts.agg(F.sum(F.octet_length(text_column).cast("long"))).first()[0] or 0
    ranges = max(math.ceil(order * size / RANGE_BYTES), 1)
    counts, told = os.path.join(folder, "counts"), os.path.join(folder, "blocks")
    _stored(_answers(_asked(texts, order, ranges), least, ranges), counts).write.parquet(told)
    all_words = spark.read.parquet(told).agg(F.sum("words")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index, block in enumerate(_runs(batches, order)):
            words, sums = block.words.astype(np.int64), np.zeros(len(block.words))
            if words.any():
                totals = _totals(f"{counts}/block-{_block_number(index)}.arrow", block.hashes)
                logs = np.append(_logs(totals, block.ends, all_words, backoff), 0.0)
                sums = np.where(words > 0, np.add.reduceat(logs, np.cumsum(words) - words), 0.0)
            yield pa.record_batch(
                [block.names, pa.array(words), pa.array(sums)], names=["doc_id", "n_words", "log_score"]
            )

    found = texts.mapInArrow(tidy(run), "doc_id long, n_words long, log_score double")
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return found.select(
        F.col("doc_id").alias(id_column), "n_words", "log_score", mean.alias("mean_log_score")
    )
