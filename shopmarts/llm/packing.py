"""Cost-balanced packing of documents into fixed-length training sequences.

A task streams its documents and packs them block by block, so nothing is shuffled and memory is
bounded by a block. Within a block

* documents longer than a sequence fill whole sequences of their own, and the rest of each is an
  item like a shorter document;
* the items need so many tokens, and exactly so many are provided: full sequences, and the binary
  parts of what is left over. Those are the lengths that need no padding;
* items go in descending order of their estimated cost ``linear * n + quadratic * n * n`` to the
  sequence of the lowest cost so far that has room for all of the item;
* items that find no such sequence are cut over the lowest-cost sequences that have room.

The block's room equals its tokens, so every sequence comes out full.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from shopmarts.llm.memory import tidy
from shopmarts.llm.tokenizing import TEXT_BYTES, encoder
from shopmarts.llm.words import blocks

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, sequence_cost double"
)
BLOCKS_PER_TASK = 1 << 20
SEQUENCES_PER_BLOCK = 1 << 20


@dataclass(frozen=True)
class Cost:
    """Estimated work of a piece of n tokens: the layers' linear part and attention's square."""

    linear: float = 1.0
    quadratic: float = 1.0 / 2048

    def of(self, tokens: int) -> float:
        return self.linear * tokens + self.quadratic * tokens * tokens


def room_for(tokens: int, width: int) -> list[int]:
    """Sequence lengths that hold exactly so many tokens and need no padding."""
    left = tokens % width
    parts = [1 << bit for bit in range(left.bit_length()) if left >> bit & 1]
    return [width] * (tokens // width) + parts[::-1]


def pack(lengths: list[int], width: int, cost: Cost) -> tuple[list[tuple[int, ...]], list[list]]:
    """Pieces ``(item, start, length, sequence, offset)`` and, per sequence, its length and cost."""
    pieces: list[tuple[int, ...]] = []
    sequences: list[list] = []
    rest = []
    for item, length in enumerate(lengths):
        for start in range(0, length - width + 1, width):
            pieces.append((item, start, width, len(sequences), 0))
            sequences.append([width, cost.of(width)])
        if length % width:
            rest.append((length % width, item))
    first = len(sequences)
    room = room_for(sum(length for length, _ in rest), width)
    used = [0] * len(room)
    spent = [0.0] * len(room)

    def place(item: int, start: int, length: int, sequence: int) -> None:
        pieces.append((item, start, length, first + sequence, used[sequence]))
        used[sequence] += length
        spent[sequence] += cost.of(length)

    rest.sort(key=lambda x: (-cost.of(x[0]), x[1]))
    lowest = [(0.0, sequence) for sequence in range(len(room))]
    aside: list[tuple[int, tuple[float, int]]] = []
    uncut = []
    for length, item in rest:
        # Items come in descending length: a sequence without room for this one is set aside until an
        # item is as short as its room.
        while aside and -aside[0][0] >= length:
            heapq.heappush(lowest, heapq.heappop(aside)[1])
        found = None
        while lowest and found is None:
            entry = heapq.heappop(lowest)
            left = room[entry[1]] - used[entry[1]]
            if left >= length:
                found = entry[1]
            else:
                heapq.heappush(aside, (-left, entry))
        if found is None:
            uncut.append((length, item))
            continue
        place(item, lengths[item] - length, length, found)
        if used[found] < room[found]:
            heapq.heappush(lowest, (spent[found], found))
    lowest += [entry for _, entry in aside]
    heapq.heapify(lowest)
    for length, item in uncut:
        start = lengths[item] - length
        while length:
            _, sequence = heapq.heappop(lowest)
            taken = min(length, room[sequence] - used[sequence])
            place(item, start, taken, sequence)
            start, length = start + taken, length - taken
            if used[sequence] < room[sequence]:
                heapq.heappush(lowest, (spent[sequence], sequence))
    sequences += [[length, total] for length, total in zip(room, spent, strict=True)]
    return pieces, sequences


def packed(
    documents: DataFrame,
    vocabulary: str,
    width: int = 1024,
    end_id: int = 0,
    cost: Cost = Cost(),  # noqa: B008
    block_tokens: int = 4_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece of a document, with the sequence it lies in and its place there.

    A null or empty text is the end id alone. Repeated rows are packed once each; ``sequence_id``
    numbers a task's sequences and is unique over all tasks. Other columns are not read, and a
    table without rows gives none.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        base = TaskContext.get().partitionId() * BLOCKS_PER_TASK * SEQUENCES_PER_BLOCK
        names: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal base, held
            pieces, sequences = pack([len(x) // 4 for x in ids], width, cost)
            rows = [
                (
                    names[item],
                    start,
                    length,
                    zlib.crc32(memoryview(ids[item])[4 * start : 4 * (start + length)]),
                    len(ids[item]) // 4,
                    base + sequence,
                    offset,
                    *sequences[sequence],
                )
                for item, start, length, sequence, offset in pieces
            ]
            base += SEQUENCES_PER_BLOCK
            held = 0
            names.clear()
            ids.clear()
            return _rows(rows)

        for batch in batches:
            for at, texts in blocks(batch.column(1), TEXT_BYTES):
                found = coder.encode(texts)
                own = batch.column(0).slice(at, len(texts)).to_pylist()
                for name, x in zip(own, found, strict=True):
                    names.append(name)
                    ids.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= block_tokens:
                        yield flush()
        if ids:
            yield flush()

    return documents.select(id_column, text_column).mapInArrow(tidy(run), SCHEMA)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 8 + [pa.float64()]
    names = [column.split()[0] for column in SCHEMA.split(", ")]
    columns = list(zip(*rows, strict=True))
    return pa.record_batch(
        [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], names=names
    )
