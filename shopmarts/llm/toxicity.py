"""Toxicity from a weighted lexicon, matched by Aho-Corasick in folded text.

Folding undoes common disguises: look-alike Cyrillic and Greek letters become Latin, digits and signs
that stand for letters become those letters, A-Z becomes lower case and other ASCII becomes a space.

The lexicon is learned: whole words and beginnings of words that labelled toxic documents have far
more often than clean ones, weighted by the lower end of their log odds. A phrase of a matched word
and its neighbour that clean documents use and toxic ones do not is an exception; it takes the
word's weight back. A document's weights are summed, divided by its length, and a logistic
function of sum and rate, fitted on the same labelled documents, gives the score.

Training reads at most ``rows`` labelled documents, those with small hashes of their ids; the
lexicon has at most ``entries`` entries.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.sampling import bounded_sample

TRAINING_ROWS = 20_000
ENTRIES = 1_000
PREFIX_LETTERS = (3, 12)  # bytes of UTF-8
LEAST_DOCUMENTS = 3

# Letters of other scripts and the Latin letters they look like.
CYRILLIC = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "А": "a", "В": "b", "Е": "e", "К": "k",
    "М": "m", "Н": "h", "О": "o", "Р": "p", "С": "c", "Т": "t", "У": "y", "Х": "x", "І": "i",
    "Ј": "j", "Ѕ": "s",
}
GREEK = {
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "τ": "t", "Α": "a",
    "Β": "b", "Ε": "e", "Ζ": "z", "Η": "h", "Ι": "i", "Κ": "k", "Μ": "m", "Ν": "n", "Ο": "o",
    "Ρ": "p", "Τ": "t", "Υ": "y", "Χ": "x",
}
LOOK_ALIKES = str.maketrans(CYRILLIC | GREEK)
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}

_TABLE = bytearray(range(256))
for _code in range(128):
    _char = chr(_code)
    _TABLE[_code] = ord(SUBSTITUTES.get(_char, _char.lower() if _char.isalpha() else " "))
_FOLD = bytes(_TABLE)
_SIGNS = re.compile(r"(?<=[^\W\d_])([@$])(?=[^\W\d_])|(?<!\S)([@$])(?=[^\W\d_])")
_OTHER_SCRIPT = re.compile("[Ͱ-ԯ]")


def fold(text: str | None) -> str:
    """The folded text between two spaces, one character per UTF-8 byte."""
    if not text:
        return "  "
    if "@" in text or "$" in text:
        text = _SIGNS.sub(lambda m: "a" if m.group() == "@" else "s", text)
    if _OTHER_SCRIPT.search(text):
        text = text.translate(LOOK_ALIKES)
    return f" {text.encode('utf-8', 'replace').translate(_FOLD).decode('latin-1')} "


@dataclass
class Model:
    """``weights`` by pattern: " word " or, for words that begin so, " wor"."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, float] = field(default_factory=dict)
    logistic: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        found = ahocorasick.Automaton()
        for pattern, weight in {**self.weights, **self.exceptions}.items():
            found.add_word(pattern, (pattern, weight))
        found.make_automaton()
        return found

    def probability(self, features: np.ndarray) -> np.ndarray:
        bias, *slopes = self.logistic
        return 1 / (1 + np.exp(-np.clip(bias + features @ np.array(slopes), -30, 30)))


def features(folded: str, automaton: ahocorasick.Automaton | None) -> tuple[float, float]:
    """Logarithms of the sum of the weights and of the sum per thousand words."""
    if automaton is None:
        return 0.0, 0.0
    total = sum(weight for _, (_, weight) in automaton.iter(folded))
    if total <= 0:
        return 0.0, 0.0
    return math.log1p(total), math.log1p(1000 * total / len(folded.split()))


def held_out(id_column: str) -> Column:
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most so many labelled documents outside the held-out fold; a document labelled twice is
    toxic if either label says so."""
    labelled = (
        labels.where(F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    # At most ``rows`` pairs of numbers are broadcast.
    some = bounded_sample(labelled, "doc_id", rows)
    return documents.select("doc_id", "text").join(F.broadcast(some), "doc_id")


def _frequencies(sample: DataFrame) -> DataFrame:
    """In how many toxic and clean documents a word occurs. The empty word is in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                counts[int(toxic > 0)].update({"", *fold(text).split()})
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.record_batch(
            [
                pa.array(words, pa.string()),
                pa.array([counts[1][w] for w in words], pa.int64()),
                pa.array([counts[0][w] for w in words], pa.int64()),
            ],
            names=["word", "toxic", "clean"],
        )

    parts = sample.select("text", "toxic").mapInArrow(run, "word string, toxic long, clean long")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _log_odds(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """The lower end: less 1.96 standard errors."""
    odds = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    return odds - 1.96 * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def train(
    documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, entries: int = ENTRIES
) -> Model:
    """A model from the labelled rows outside the held-out fold. Without any of either label it has
    no lexicon and scores all texts alike.

    At most ``rows`` labelled documents are learned from, their words whatever their length; the model
    has at most ``entries`` patterns and as many exceptions, those of the most documents."""
    sample = _sample(documents, labels, rows).persist()
    try:
        return _trained(sample, entries)
    finally:
        sample.unpersist()


def _trained(sample: DataFrame, entries: int) -> Model:
    words = _frequencies(sample).persist()
    try:
        all_ = words.where("word = ''").first()
        if all_ is None or not all_["toxic"] or not all_["clean"]:
            return Model()
        size = (all_["toxic"], all_["clean"])
        low, high = PREFIX_LETTERS
        begins = words.select(
            F.explode(
                F.expr(
                    f"transform(sequence({low}, {high}), n -> struct(left(word, n) AS p, n < length(word) AS more))"
                )
            ).alias("s"),
            "toxic",
            "clean",
        ).where("s.more")
        patterns = words.where("word <> ''").select(
            F.concat(F.lit(" "), "word", F.lit(" ")).alias("pattern"), "toxic", "clean"
        ).unionByName(
            begins.groupBy(F.concat(F.lit(" "), "s.p").alias("pattern")).agg(
                F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
            )
        )
        weight = _log_odds(F.col("toxic"), F.col("clean"), *size)
        best = (
            patterns.where(F.col("toxic") >= LEAST_DOCUMENTS)
            .withColumn("weight", weight)
            .where(F.col("weight") > math.log(3))
            .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), F.desc(F.length("pattern")), "pattern")
            .limit(4 * entries)
            .collect()
        )
    finally:
        words.unpersist()
    weights: dict[str, float] = {}
    for row in best:
        pattern = row["pattern"]
        if len(weights) < entries and not _nested(pattern, weights):
            weights[pattern] = row["weight"]
    model = Model(weights)
    model.exceptions = _exceptions(sample, model, size, entries)
    model.logistic = _fitted(sample, model)
    return model


def _nested(pattern: str, chosen: dict[str, float]) -> bool:
    """Whether one is the beginning of the other, so that a word would count twice."""
    return any(pattern.startswith(other) or other.startswith(pattern) for other in chosen)


def _exceptions(
    sample: DataFrame, model: Model, size: tuple[int, int], entries: int
) -> dict[str, float]:
    """Two-word phrases around matched words that speak for a clean document."""
    weights = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        rows: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                folded = fold(text)
                phrases = set()
                for end, (pattern, _) in automaton.iter(folded) if automaton else ():
                    start = end - len(pattern) + 1
                    until = folded.find(" ", start + 1) + 1
                    begin = folded.rfind(" ", 0, start) + 1
                    if 0 < begin < start:
                        phrases.add((folded[begin - 1 : until], pattern))
                    behind = folded.find(" ", until)
                    if behind > until:
                        phrases.add((folded[start : behind + 1], pattern))
                rows.update((phrase, pattern, int(toxic > 0)) for phrase, pattern in phrases)
        yield pa.record_batch(
            [
                pa.array([x[0] for x in rows], pa.string()),
                pa.array([x[1] for x in rows], pa.string()),
                pa.array([n * x[2] for x, n in rows.items()], pa.int64()),
                pa.array([n * (1 - x[2]) for x, n in rows.items()], pa.int64()),
            ],
            names=["phrase", "pattern", "toxic", "clean"],
        )

    counted = (
        sample.select("text", "toxic")
        .mapInArrow(run, "phrase string, pattern string, toxic long, clean long")
        .groupBy("phrase", "pattern")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("clean") >= LEAST_DOCUMENTS)
    )
    speaks = _log_odds(F.col("clean"), F.col("toxic"), size[1], size[0]) > 0
    rows = counted.where(speaks).orderBy(F.desc("clean"), "phrase").limit(entries).collect()
    return {row["phrase"]: -weights[row["pattern"]] for row in rows}


def _fitted(sample: DataFrame, model: Model) -> tuple[float, float, float]:
    """Logistic regression on two numbers per sampled document, by Newton's method."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = [features(fold(text), automaton) for text in batch.column(0).to_pylist()]
            yield pa.record_batch(
                [
                    pa.array([x for x, _ in found], pa.float64()),
                    pa.array([y for _, y in found], pa.float64()),
                    batch.column(1).cast(pa.float64()),
                ],
                names=["total", "rate", "toxic"],
            )

    rows = (
        sample.select("text", "toxic").mapInArrow(run, "total double, rate double, toxic double").toPandas()
    )
    rows = rows.sort_values(["total", "rate", "toxic"])  # the same sums in any order of tasks
    x = np.column_stack([np.ones(len(rows)), rows[["total", "rate"]].to_numpy()])
    y = (rows["toxic"].to_numpy() > 0).astype(float)
    slopes = np.zeros(3)
    penalty = np.diag([1e-3, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ slopes, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, x.T @ (y - p) - penalty @ slopes)
        slopes = slopes + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in slopes)


def score(model: Model, text: Column) -> Column:
    """A toxicity score from 0 to 1 for any text; a null or empty one has nothing against it."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = model.automaton()
        for texts in batches:
            found = np.array([features(fold(t), automaton) for t in texts]).reshape(-1, 2)
            yield pd.Series(model.probability(found))

    return scored(text)


def scored(
    documents: DataFrame, model: Model, threshold: float = 0.3, id_column: str = "doc_id"
) -> DataFrame:
    """Per document row ``doc_id, held_out, score, predicted``. Repeated rows are scored each; other
    columns are not read; a row without an id is not held out."""
    return documents.select(
        id_column, held_out(id_column).alias("held_out"), score(model, F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def kept(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    return documents.where(score(model, F.col("text")) < threshold)
