"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Two words whose longer one has ``m`` code points are one edit apart when their common prefix and
their common suffix together reach ``m - 1``. The place of the edit is the length of the common
prefix. The places 0 to m - 1 are cut into windows, and a tile holds the words that agree before and
behind one window: every near pair meets in the tile of its window and is counted there alone.

Up to 64 code points a window is two wide, so a tile has at most a^2 + a words over an alphabet of a
letters, however large the corpus is. Longer words have 32 windows. The words of a tile are
compared as blocks of padded code-point matrices, so memory does not grow with the tile.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.session import scratch_dir

LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
WINDOWS = 32  # at most, per length
SLICE = 1 << 20  # bytes of a text that are searched at once
HELD = 200_000  # words a task counts before it hands them on
CELLS = 1 << 22  # of a matrix of compared pairs

_BOUNDARY = re.compile(rb"[^a-z\x80-\xff]")
_PAIRED = "word string, n_near long, near_n long, near string"


def _slices(data: bytes) -> Iterator[str]:
    """A text in pieces that end where no run and no character is cut."""
    at = 0
    while at < len(data):
        found = _BOUNDARY.search(data, at + SLICE) if at + SLICE < len(data) else None
        end = found.start() if found else len(data)
        yield data[at:end].decode("utf-8", "replace")
        at = end


def _counter(least_length: int, every: int):
    # Shorter runs cannot become words: a run only ever loses a code point.
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            rows = [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())]
            total.clear()
            return pa.RecordBatch.from_arrays(rows, names=["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                begin = zlib.crc32(f"{name.as_py() if name.is_valid else ''}:".encode())
                for piece in _slices(text.as_py().lower()):
                    for run, n in Counter(runs.findall(piece)).items():
                        h = zlib.crc32(run.encode(), begin)
                        if h % every == 0:
                            place = h % len(run)
                            run = run[:place] + run[place + 1 :]
                            if len(run) < least_length:
                                continue
                        total[run] += n
                    if len(total) > HELD:
                        yield handed()
        if total:
            yield handed()

    return counted


def counted_words(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    every: int = 31,
) -> DataFrame:
    """``word, n`` of the letter runs of all whole texts, in lower case as far as A-Z goes.

    A run whose checksum with its document's id is divisible by ``every`` loses a code point. A null
    text has no words; a null id stands as nothing before the colon.
    """
    texts = documents.select(F.col(id_column), F.col(text_column).cast("string").cast("binary"))
    words = texts.mapInArrow(_counter(least_length, every), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _width(longer: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(longer / WINDOWS)).cast("int")


def tiles(words: DataFrame) -> DataFrame:
    """``longer, place, width, tile, word, n``: each word in the tiles of its own length and of the next."""
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    sized = sized.withColumn("width", _width(F.col("longer")))
    placed = sized.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("longer") - 1, "width")))
    behind = F.greatest(F.col("longer") - F.col("place") - F.col("width"), F.lit(0))
    return placed.select(
        "longer",
        "place",
        "width",
        F.xxhash64(
            F.expr("substring(word, 1, place)"),
            F.substring("word", F.length("word") - behind + 1, behind),
        ).alias("tile"),
        "word",
        "n",
    )


def _matrices(words: list[str], longer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, aligned left and aligned right, zeros beside them; and lengths."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    if not len(points) or points.max() < 256:
        points = points.astype(np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    row = np.repeat(np.arange(len(words)), length)
    column = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
    left = np.zeros((len(words), longer), points.dtype)
    left[row, column] = points
    right = np.zeros_like(left)
    right[row, column + (longer - length)[row]] = points
    return left, right, length


def near_pairs(
    left: np.ndarray, right: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows: whether one edit parts them, and the length of their common prefix.

    The matrices are as wide as the longer word of a pair; pairs of two shorter words are not near
    here but in the tiles of their own length.
    """
    longer = left.shape[1]
    prefix = np.argmin(left[a] == left[b], axis=1)
    suffix = np.argmin((right[a] == right[b])[:, ::-1], axis=1)
    wide = np.maximum(length[a], length[b]) == longer
    return wide & (prefix + suffix >= longer - 1), prefix


def _block_pairs(end: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each row with the later rows of its tile, at most ``most`` at once or one row's."""
    rows = np.arange(len(end))
    after = end - rows - 1
    total = np.concatenate([[0], np.cumsum(after)])
    at = 0
    while at < len(end):
        until = max(int(np.searchsorted(total, total[at] + most, "right")) - 1, at + 1)
        a = np.repeat(rows[at:until], after[at:until])
        step = np.arange(len(a)) - np.repeat(total[at:until] - total[at], after[at:until])
        yield a, a + 1 + step
        at = until


def _compared(batch: pa.Table) -> Iterator[pa.RecordBatch]:
    """Partial answers of whole tiles of one length: per word its near words here and the best."""
    longer = batch["longer"][0].as_py()
    tile, place = (batch[c].to_numpy() for c in ("tile", "place"))
    change = np.flatnonzero((tile[1:] != tile[:-1]) | (place[1:] != place[:-1])) + 1
    bounds = np.concatenate([[0], change, [len(tile)]])
    sizes = np.diff(bounds)
    shared = np.repeat(sizes > 1, sizes)
    if not shared.any():
        return
    rows = batch.filter(pa.array(shared))
    sizes = sizes[sizes > 1]
    end = np.repeat(np.cumsum(sizes), sizes)
    names = rows["word"].to_pylist()
    n, place, width = (rows[c].to_numpy() for c in ("n", "place", "width"))
    left, right, length = _matrices(names, longer)
    order = sorted(range(len(names)), key=lambda i: (-n[i], names[i]))
    rank = np.empty(len(names), np.int64)
    rank[order] = np.arange(len(names))
    count = np.zeros(len(names), np.int64)
    best = np.full(len(names), len(names))
    for a, b in _block_pairs(end, max(CELLS // longer, 1)):
        near, edit = near_pairs(left, right, length, a, b)
        near &= (edit >= place[a]) & (edit < place[a] + width[a])
        a, b = a[near], b[near]
        for own, other in ((a, b), (b, a)):
            count += np.bincount(own, minlength=len(names))
            np.minimum.at(best, own, rank[other])
    found = np.flatnonzero(count)
    if len(found):
        to = np.array(order)[best[found]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in found], pa.string()),
                pa.array(count[found]),
                pa.array(n[to].astype(np.int64)),
                pa.array([names[i] for i in to], pa.string()),
            ],
            names=["word", "n_near", "near_n", "near"],
        )


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by length, window and tile. A tile that goes on in the next batch waits for it."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        keys = np.stack([held[c].to_numpy() for c in ("longer", "place", "tile")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if len(change):
            yield from _by_length(held.slice(0, change[-1]))
            held = held.slice(change[-1])
    if held is not None:
        yield from _by_length(held)


def _by_length(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    longer = rows["longer"].to_numpy()
    bounds = [0, *(np.flatnonzero(longer[1:] != longer[:-1]) + 1).tolist(), len(longer)]
    for at, until in zip(bounds, bounds[1:]):
        yield from _compared(rows.slice(at, until - at).combine_chunks())


def variants(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """``word, n`` with ``n_near, form, form_n, root`` for every word; words must be distinct.

    ``form`` is the near word of largest ``n``, the smallest in code-point order of equals, if its
    ``n`` is at least ``factor`` times the word's. Forms are followed to the last, the ``root``. As
    ``n`` grows by the factor with each step, a chain is short. No words give no rows.
    """
    spark = words.sparkSession
    folder = scratch_dir(spark, "spelling")

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    words = written(words.select("word", "n"), "words")
    order = ("longer", "place", "tile")
    dealt = tiles(words).repartition("tile").sortWithinPartitions(*order)
    pairs = dealt.mapInArrow(_paired, _PAIRED)
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less:long,near:string>").alias("best"))
    some = pairs.select(
        "word",
        F.lit(None).cast("long").alias("n"),
        "n_near",
        F.struct((-F.col("near_n")).alias("less"), "near").alias("best"),
    )
    merged = none.unionByName(some).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    chosen = -F.col("best.less") >= F.lit(factor) * F.col("n")
    found = written(
        merged.select(
            "word",
            F.when(chosen, F.col("best.near")).alias("form"),
            "n",
            "n_near",
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    step = 0
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = written(roots.join(ahead, "root", "left"), f"roots-{step}")
        moved = not roots.where("further IS NOT NULL").isEmpty()
        roots = roots.select("word", F.coalesce("further", "root").alias("root"))
        if not moved:
            break
        step += 1
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
