"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams of one to three letters, words standing
between blanks. A document has such a list of its own. Its distance to a language is the sum, over
its n-grams, of how far each is out of place in the language's list; an n-gram that the language does
not list counts as the whole list's length. The nearest language is the prediction.

Profiles are trained on about ``rows`` documents of each language at most, those with small hashes of
their ids, outside the held-out fold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.sampling import bounded_sample_by

TRAINING_ROWS = 2_000
LISTED = 400
ORDERS = (1, 2, 3)
SCHEMA = "lang_pred string, score double"

_LETTER = np.array([chr(code).isalpha() for code in range(0x110000)])
_WIDE = np.uint64(21)  # bits of a code point


def letters(text: str | None) -> np.ndarray:
    """Code points in lower case; whatever is no letter is one blank, also before and after."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
    is_letter = _LETTER[points]
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]  # the first blank after a word
    kept[0] = True
    return np.where(is_letter, points, 0)[kept].astype(np.uint64)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The text's n-grams as ascending numbers, and how often each occurs."""
    points = letters(text)
    if len(points) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    runs = []
    for order in ORDERS:
        key = np.zeros(len(points) - order + 1, np.uint64)
        for place in range(order):
            key = key << _WIDE | points[place : place + len(key)]
        if order == 1:
            key = key[key > 0]
        if order == 3:
            key = key[points[1 : 1 + len(key)] > 0]  # no blank in the middle
        runs.append(key | np.uint64(order) << np.uint64(62) if order < 3 else key)
    found = np.sort(np.concatenate(runs))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    return found[first], np.diff(np.append(first, len(found)))


def ranked(keys: np.ndarray, counts: np.ndarray, listed: int) -> np.ndarray:
    """The most frequent n-grams, the first first; of equal counts the smaller number."""
    return keys[np.argsort(-counts, kind="stable")[:listed]]


def held_out(id_column: str) -> Column:
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


Profiles = dict[str, np.ndarray]


def train(documents: DataFrame, rows: int = TRAINING_ROWS, listed: int = LISTED) -> Profiles:
    """A profile for each language of the labelled documents outside the held-out fold."""
    labelled = documents.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")
    )
    sample = bounded_sample_by(labelled.select("doc_id", "lang", "text"), "lang", "doc_id", rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                keys, counts = grams(text)
                yield pa.record_batch(
                    [
                        pa.array([lang] * len(keys), pa.string()),
                        pa.array(keys.view(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names=["lang", "gram", "n"],
                )

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = (
        sample.select("lang", "text")
        .mapInArrow(run, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= listed)
        .select("lang", "place", "gram")
        .toPandas()
    )
    return {
        lang: part.sort_values("place")["gram"].to_numpy().view(np.uint64)
        for lang, part in sorted(top.groupby("lang"))
    }


def distances(own: np.ndarray, profiles: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Out-of-place distances of a ranked list to profiles of ``(sorted n-grams, their ranks)``."""
    place = np.arange(len(own))
    found = []
    for keys, ranks in profiles:
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        listed = keys[at] == own
        found.append(np.where(listed, np.abs(ranks[at] - place), LISTED).sum())
    return np.array(found)


def predict(profiles: Profiles, text: Column) -> Column:
    """``lang_pred`` and ``score`` for any text. The score is one minus the nearest distance as a
    share of the largest possible one. A text that is null or has no letter is ``und`` with score 0,
    and so is every text without profiles. Of equally near languages the first by name is taken."""
    names = sorted(profiles)
    tables = []
    for name in names:
        order = np.argsort(profiles[name])
        tables.append((profiles[name][order], order))

    @F.pandas_udf(SCHEMA)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                own = ranked(*grams(text), LISTED)
                if not len(own) or not names:
                    rows.append(("und", 0.0))
                    continue
                far = distances(own, tables)
                best = int(far.argmin())
                rows.append((names[best], 1 - float(far[best]) / (LISTED * len(own))))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return predicted(text)


def identified(documents: DataFrame, profiles: Profiles, id_column: str = "doc_id") -> DataFrame:
    """Per document row ``doc_id, held_out, lang_pred, score``. Repeated rows are judged each; other
    columns are not read; a row without an id is not held out."""
    found = documents.select(
        id_column, held_out(id_column).alias("held_out"), predict(profiles, F.col("text")).alias("p")
    )
    return found.select(id_column, "held_out", "p.lang_pred", "p.score")
