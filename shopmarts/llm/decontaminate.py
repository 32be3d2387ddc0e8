"""Benchmark decontamination as a prefix-filtered set join on word shingles.

A benchmark item is cut into windows of 13 consecutive words; a shorter item is one window. A
window occurs in a document only if all its shingles (runs of four words, or all words of a shorter
window) do. So one shingle of each window is enough to find every place where it can occur, and
the rarest one finds the fewest others: that is the prefix of length one that a containment of 100 %
asks for.

1. The windows' shingles are marked in a bitmap of fixed size, the only thing that is broadcast.
2. One pass over the documents keeps the passages around marked shingles, with the shingles' places.
   This is written once; the texts are not read or moved again.
3. The kept shingles are counted. Windows with a shingle that no document has drop out; of each
   other window, the rarest shingle is joined with the places that have it.
4. Place minus offset is where the window would begin. It must lie in the passage with its whole
   length, and its words must equal the window's.

Words are what lies between ASCII characters other than letters and digits, with A-Z in lower case.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmarts.llm.words import ALPHANUMERIC, blocks, find_words, shingle_hashes
from shopmarts.session import scratch_dir

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SHINGLE = 4
BITMAP_BITS = 24  # 2 MB, whatever the benchmark's size

WINDOWS = "item_id long, window string, n_words int, shingles array<long>"
PASSAGES = (
    "row long, doc_id long, n_words long, "
    "passages array<struct<first: int, words: string, at: array<int>, shingle: array<long>>>"
)


def windows_of(items: DataFrame, size: int = 13) -> DataFrame:
    """Every window of every item, with the hashes of its shingles by offset. An item without words
    has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in blocks(batch.column(1)):
                found = find_words(texts, ALPHANUMERIC)
                by_size = {n: shingle_hashes(found.hash, n) for n in range(1, SHINGLE + 1)}
                rows = []
                for name, text, first, count in zip(
                    batch.column(0).slice(at, len(texts)).to_pylist(),
                    texts.to_pylist(),
                    found.first.tolist(),
                    found.counts.tolist(),
                    strict=False,
                ):
                    words = WORD.findall(_lower(text or ""))
                    length = min(size, count)
                    for start in range(count - length + 1 if count else 0):
                        n = min(SHINGLE, length)
                        own = by_size[n][first + start : first + start + length - n + 1]
                        rows.append(
                            (name, " ".join(words[start : start + length]), length, own.view(np.int64))
                        )
                if rows:
                    yield pa.record_batch(
                        [
                            pa.array(column, kind)
                            for column, kind in zip(
                                zip(*rows, strict=True),
                                (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64())),
                                strict=True,
                            )
                        ],
                        names=["item_id", "window", "n_words", "shingles"],
                    )

    return items.mapInArrow(run, WINDOWS)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _lower(text: str) -> str:
    return text.translate(_LOWER)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """One bit per hashed shingle. At most 2^18 rows of 64 bits come to the driver."""
    words = (
        windows.select(F.explode("shingles").alias("shingle"))
        .select(F.shiftrightunsigned("shingle", 64 - BITMAP_BITS).cast("int").alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"))
    )
    marked = np.zeros(1 << BITMAP_BITS - 6, np.int64)
    for word, bits in words.toLocalIterator():
        marked[word] = bits
    return np.unpackbits(marked.view(np.uint8), bitorder="little").view(bool)


def _passages(documents: DataFrame, marked: np.ndarray, sizes: list[int], size: int) -> DataFrame:
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(np.packbits(marked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_marked = np.unpackbits(shared.value).view(bool)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at, texts in blocks(batch.column(1)):
                names = batch.column(0).slice(at, len(texts))
                yield _passages_of(names, texts, row, is_marked, sizes, size)
                row += len(texts)

    return documents.mapInArrow(run, PASSAGES)


def _passages_of(
    names: pa.Array, texts: pa.Array, row: int, marked: np.ndarray, sizes: list[int], size: int
) -> pa.RecordBatch:
    found = find_words(texts, ALPHANUMERIC)
    text_of = np.repeat(np.arange(len(texts)), found.counts)
    places, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in sizes:
        shingles = shingle_hashes(found.hash, n)
        at = np.flatnonzero(marked[shingles >> np.uint64(64 - BITMAP_BITS)])
        at = at[text_of[at] == text_of[at + n - 1]]
        places.append(at)
        hashes.append(shingles[at])
    at, shingle = np.concatenate(places), np.concatenate(hashes).view(np.int64)
    order = np.argsort(at, kind="stable")
    at, shingle = at[order], shingle[order]
    own = text_of[at]
    low = np.maximum(at - size + 1, found.first[own])
    high = np.minimum(at + size, found.first[own + 1])
    # A passage goes on while its shingles' surroundings touch within one text.
    begins = np.ones(len(at), bool)
    if len(at):
        begins[1:] = (low[1:] > np.maximum.accumulate(high)[:-1]) | (own[1:] != own[:-1])
    heads = np.append(np.flatnonzero(begins), len(at))
    passages: list[list] = [[] for _ in range(len(texts))]
    for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
        first, until = int(low[a]), int(high[a:b].max())
        words = WORD.findall(found.slice_text(first, until).decode("utf-8", "replace"))
        base = int(found.first[own[a]])
        passages[own[a]].append(
            {"first": first - base, "words": " ".join(words), "at": at[a:b] - base, "shingle": shingle[a:b]}
        )
    return pa.record_batch(
        [
            pa.array(np.arange(row, row + len(texts))),
            names.cast(pa.int64()),
            pa.array(found.counts.astype(np.int64)),
            pa.array(passages, _PASSAGES_KIND),
        ],
        names=["row", "doc_id", "n_words", "passages"],
    )


_PASSAGES_KIND = pa.list_(
    pa.struct(
        [
            ("first", pa.int32()),
            ("words", pa.string()),
            ("at", pa.list_(pa.int32())),
            ("shingle", pa.list_(pa.int64())),
        ]
    )
)


def occurrences(
    spark: SparkSession, documents: DataFrame, items: DataFrame, size: int = 13
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per document row its id and word count; where which window occurs; which items have it.

    The second table has ``row, start, n_words, window``: the window's words stand in the document
    from word ``start`` on.
    """
    folder = scratch_dir(spark, "decontaminate")

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    windows = written(windows_of(items, size), "windows")
    sizes = [
        n for (n,) in windows.select(F.least("n_words", F.lit(SHINGLE))).distinct().collect()
    ]  # at most four
    pages = written(_passages(documents, _bitmap(windows), sorted(sizes), size), "passages")

    passages = pages.select(
        "row", F.posexplode("passages").alias("passage", "p")
    )
    places = passages.select(
        "row", "passage", F.explode(F.arrays_zip("p.at", "p.shingle")).alias("s")
    ).select("row", "passage", F.col("s.at").alias("at"), F.col("s.shingle").alias("shingle"))
    seen = places.groupBy("shingle").agg(F.count("*").alias("seen"))
    distinct = windows.groupBy("window").agg(
        F.first("n_words").alias("n_words"), F.first("shingles").alias("shingles")
    )
    rarest = (
        distinct.select("window", "n_words", F.posexplode("shingles").alias("offset", "shingle"))
        .join(seen, "shingle", "left")
        .groupBy("window", "n_words")
        .agg(
            F.min(
                F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "shingle", "offset")
            ).alias("prefix")
        )
        .where("prefix.seen > 0")
        .select("window", "n_words", "prefix.shingle", "prefix.offset")
    )
    candidates = places.join(rarest, "shingle").select(
        "row", "passage", (F.col("at") - F.col("offset")).alias("start"), "n_words", "window"
    )
    texts = passages.select(
        "row", "passage", "p.first", F.split("p.words", " ").alias("words")
    )
    skipped = F.col("start") - F.col("first")
    fits = (skipped >= 0) & (skipped + F.col("n_words") <= F.size("words"))
    same = F.array_join(F.slice("words", skipped + 1, F.col("n_words")), " ") == F.col("window")
    found = (
        candidates.join(texts, ["row", "passage"])
        .where(F.when(fits, same).otherwise(F.lit(False)))
        .select("row", "start", "n_words", "window")
    )
    return (
        pages.select("row", "doc_id", "n_words"),
        written(found, "occurrences"),
        windows.select("window", "item_id").distinct(),
    )


def contamination(
    documents: DataFrame,
    items: DataFrame,
    size: int = 13,
    share: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word inside any occurrence of a window is hit. A document is contaminated if any word is and
    ``share * n_hit >= n_words``. Null and empty texts have no words and are clean; an empty
    benchmark leaves all clean; repeated rows are judged each; an item that comes twice counts once.
    Other columns are not read. A null item id is an item whose id is left out of the digest.
    """
    pages, found, items_of = occurrences(
        documents.sparkSession,
        documents.select(F.col(id_column).cast("long"), text_column),
        items.select(F.col(item_column).cast("long"), item_text_column),
        size,
    )
    end = F.col("start") + F.col("n_words")
    before = Window.partitionBy("row").orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    spans = found.select("row", "start", end.alias("end")).distinct()
    hits = (
        spans.select(
            "row", (F.col("end") - F.greatest("start", F.coalesce(reached, F.lit(0)))).alias("new")
        )
        .groupBy("row")
        .agg(F.sum(F.greatest("new", F.lit(0))).cast("long").alias("n_hit"))
    )
    named = (
        found.select("row", "window")
        .distinct()
        .join(items_of, "window")
        .groupBy("row")
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (
        pages.join(hits, "row", "left")
        .join(named, "row", "left")
        .select(
            F.col("doc_id").alias(id_column),
            "n_words",
            n_hit.alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort(listed), ",").cast("binary"), 256).alias("items_sha256"),
            ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        )
    )


def clean(
    documents: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options: object,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    A verdict belongs to a text, so rows are told apart by a hash of theirs: rows without an id, and
    rows that share one, are each judged by their own text.
    """
    keyed = documents.withColumn("_text_hash", F.xxhash64(text_column))
    judged = contamination(keyed, items, id_column="_text_hash", text_column=text_column, **options)
    # Written first, so that its size is known when the join is planned: as long as it is small, the
    # documents are not shuffled.
    spark = documents.sparkSession
    path = os.path.join(scratch_dir(spark, "contaminated"), "texts")
    judged.where("contaminated").select("_text_hash").distinct().write.parquet(path)
    rejected = spark.read.parquet(path)
    kept = keyed.join(rejected, "_text_hash", "left_anti")
    return kept.select(*documents.columns)
