"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample; every vector is then put into a leaf. A query walks down the tree
with a priority queue of branches, nearest first, so that it lists the leaves in the order in which
they are worth a visit. How many leaves a query visits is calibrated: for a sample of queries the true
neighbours are found by scanning all vectors in blocks, and visits widen until the leaves hold the
wanted share of them.

A vector of norm r is placed, one dimension higher, at height sqrt(R^2 - r^2), R being the largest
norm. All vectors then lie on one sphere, and the nearest by distance to a query (at height 0) is the
one with the largest inner product.

Leaves are stored in files of bounded size, so a leaf that holds very many equal vectors is spread. The
queries are what is dealt to tasks, in blocks that begin at the same leaves: a block reads the files of
the leaves that its queries visit, one at a time, the most urgent leaves first, and keeps each query's
best. So a query is one row that meets no join, and gives no more rows than it has neighbours. A file's
vectors are only looked at more closely if they may beat a query's worst neighbour so far.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.files import put
from shopmarts.llm.memory import tidy
from shopmarts.llm.sampling import bounded_sample
from shopmarts.session import scratch_dir

BRANCHES = 8
SAMPLE_ROWS = 50_000  # at most, of the vectors with small hashes of their ids
LEAF_SAMPLE = 300  # sampled vectors in a leaf at most, but for equal ones
CALIBRATION_QUERIES = 200
RECALL = 0.95  # wanted on the calibration queries; 0.9 is promised
BLOCK_ROWS = 4_096  # scanned at a time; about as many of a leaf are in a file
QUERY_BLOCK = 256  # queries that read the leaves together


@dataclass
class Tree:
    """``centres[i]`` are the centres of node i's children, ``children[i]`` their numbers; a child
    below zero is leaf ``-1 - child``."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int
    radius: float  # R, the largest norm

    def raised(self, vectors: np.ndarray) -> np.ndarray:
        gap = np.maximum(self.radius**2 - (vectors**2).sum(axis=1), 0)
        return np.column_stack([vectors, np.sqrt(gap)])

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector, going to the nearest centre at each node."""
        found = np.zeros(len(vectors), np.int64)
        points = self.raised(vectors)
        waiting = [(0, np.arange(len(vectors)))] if self.centres else []
        while waiting:
            node, rows = waiting.pop()
            nearest = _nearest(points[rows], self.centres[node])
            for branch, child in enumerate(self.children[node]):
                own = rows[nearest == branch]
                if not len(own):
                    continue
                if child < 0:
                    found[own] = -1 - child
                else:
                    waiting.append((child, own))
        return found

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in the order of a best-bin-first search."""
        if not self.centres:
            return [0][:most]
        point = np.append(query, 0.0)
        order, queue, ticket = [], [(0.0, 0, 0)], 0
        while queue and len(order) < most:
            _, _, node = heapq.heappop(queue)
            if node < 0:
                order.append(-1 - node)
                continue
            away = ((self.centres[node] - point) ** 2).sum(axis=1)
            for far, child in zip(away.tolist(), self.children[node], strict=True):
                ticket += 1
                heapq.heappush(queue, (far, ticket, child))
        return order


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (-2 * points @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)


def _split(points: np.ndarray, branches: int, rng: np.random.Generator) -> np.ndarray | None:
    """Centres by Lloyd's k-means; none if all points are equal."""
    distinct = np.unique(points, axis=0)
    if len(distinct) < 2:
        return None
    count = min(branches, len(distinct))
    centres = distinct[rng.choice(len(distinct), count, replace=False)]
    for _ in range(12):
        nearest = _nearest(points, centres)
        filled = np.unique(nearest)
        moved = np.stack([points[nearest == c].mean(axis=0) for c in filled])
        if moved.shape == centres.shape and np.allclose(moved, centres):
            break
        centres = moved
    return centres if len(centres) > 1 else None


def fit(sample: np.ndarray, radius: float, seed: int = 0) -> Tree:
    """The tree over the sampled vectors."""
    tree = Tree([], [], 0, radius)
    rng = np.random.default_rng(seed)

    def grow(points: np.ndarray) -> int:
        centres = _split(points, BRANCHES, rng) if len(points) > LEAF_SAMPLE else None
        if centres is None:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        nearest = _nearest(points, centres)
        tree.children[node] = [grow(points[nearest == c]) for c in range(len(centres))]
        return node

    grow(tree.raised(sample))
    return tree


def usable(
    vectors: DataFrame, id_column: str, vector_column: str, dimensions: int | None = None
) -> DataFrame:
    """``vec_id, vector`` of the vectors that take part, as doubles.

    Left out are null and empty vectors, those with a null, infinite or not-a-number component, and
    those that are zero throughout; also rows without an id, and vectors of other ``dimensions``.
    """
    typed = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    fits = F.lit(True) if dimensions is None else F.size("vector") == dimensions
    return typed.where(
        F.col("vec_id").isNotNull() & fits & finite & F.exists("vector", lambda x: x != 0)
    )


def _matrix(lists: pa.ListArray) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, equal ones by smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in the same order wherever they are computed."""
    return np.einsum("qd,nd->qn", queries, vectors)


FOUND = "query_id long, vec_id long, score double"


def _found(query_ids: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> pd.DataFrame:
    parts = []
    for row, query in enumerate(query_ids):
        others = np.flatnonzero(ids != query)
        best = others[_best(scores[row, others], ids[others], k)]
        parts.append((np.full(len(best), query), ids[best], scores[row, best]))
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))


def _merged(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def brute_force(vectors: DataFrame, queries: list[tuple[int, list[float]]], k: int) -> DataFrame:
    """The exact neighbours of a bounded list of queries, by scanning all vectors in blocks."""
    query_ids = np.array([name for name, _ in queries], np.int64)
    asked = np.array([vector for _, vector in queries], np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows = batch.slice(at, BLOCK_ROWS)
                ids, points = rows.column(0).to_numpy(), _matrix(rows.column(1))
                found = _found(query_ids, ids, _scores(asked, points), k)
                yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return _merged(vectors.select("vec_id", "vector").mapInArrow(run, FOUND), k)


@dataclass(frozen=True)
class Index:
    tree: Tree
    vectors: DataFrame  # vec_id, vector, leaf; written once
    folder: str  # holds the leaves' files
    files: dict[int, int]  # how many each leaf has; there are no more leaves than the sample gives
    dimensions: int  # those that most vectors have
    leaves_visited: int
    recall: float  # measured against brute force on the calibration queries


def build(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    wanted: float = RECALL,
) -> Index:
    """Fit the tree, index every vector, and calibrate the visits for ``queries`` and ``k``."""
    spark = vectors.sparkSession
    every = usable(vectors, id_column, vector_column)
    sizes = every.groupBy(F.size("vector").alias("d")).count()
    most = sizes.orderBy(F.desc("count"), "d").first()
    dimensions = most["d"] if most else 0
    points = usable(vectors, id_column, vector_column, dimensions)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    radius = points.agg(F.max(norm)).first()[0] or 0.0
    sample = bounded_sample(points, "vec_id", SAMPLE_ROWS).toPandas().sort_values("vec_id")
    rows = np.array(sample["vector"].tolist(), np.float64).reshape(len(sample), dimensions)
    tree = fit(rows, radius * (1 + 1e-9))
    shared = spark.sparkContext.broadcast(tree)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.leaf_of(_matrix(batch.column(1)))
                yield pa.record_batch([*batch.columns, pa.array(leaf)], names=["vec_id", "vector", "leaf"])

    folder = scratch_dir(spark, "ann")
    path = os.path.join(folder, "vectors")
    points.mapInArrow(run, "vec_id long, vector array<double>, leaf long").write.parquet(path)
    indexed = spark.read.parquet(path)
    files = _filed(indexed, os.path.join(folder, "leaves"))

    asked = [
        (row[0], row[1])
        for row in bounded_sample(
            usable(queries, id_column, vector_column, dimensions), "vec_id", CALIBRATION_QUERIES
        ).collect()
    ]
    if not asked:
        return Index(tree, indexed, folder, files, dimensions, 1, 1.0)
    true = brute_force(indexed, asked, k)
    true = true.join(indexed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    order = {name: tree.visits(np.array(vector), tree.leaves) for name, vector in asked}
    place = {name: dict(zip(leaves, range(1, len(leaves) + 1), strict=True)) for name, leaves in order.items()}
    needed = np.sort([place[q][leaf] for q, leaf in zip(true["query_id"], true["leaf"], strict=True)])
    if not len(needed):
        return Index(tree, indexed, folder, files, dimensions, tree.leaves, 1.0)
    visited = int(needed[min(int(np.ceil(wanted * len(needed))), len(needed)) - 1])
    return Index(tree, indexed, folder, files, dimensions, visited, float((needed <= visited).mean()))


def _filed(indexed: DataFrame, folder: str) -> dict[int, int]:
    """The leaves' vectors as Arrow files. Returns how many files each leaf has."""
    rows = indexed.groupBy("leaf").agg(F.count("*").alias("rows"))
    files = {row["leaf"]: -(-row["rows"] // BLOCK_ROWS) for row in rows.collect()}
    if not files:
        return files
    counts = indexed.sparkSession.createDataFrame(sorted(files.items()), "leaf long, files int")

    def run(rows: pa.Table) -> pa.Table:
        leaf, part = (rows.column(name)[0].as_py() for name in ("leaf", "part"))
        with pa.BufferOutputStream() as out:
            stored = rows.select(["vec_id", "vector"]).filter(rows.column("vec_id").is_valid()).combine_chunks()
            with pa.ipc.new_file(out, stored.schema) as file:
                file.write_table(stored)
            put(f"{folder}/leaf-{leaf}-{part}.arrow", out.getvalue().to_pybytes())
        return pa.table({"leaf": pa.array([leaf]), "part": pa.array([part])})

    dealt = indexed.join(F.broadcast(counts), "leaf").withColumn(
        "part", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("files"))
    )
    every = F.explode(F.sequence(F.lit(0), F.col("files") - 1).cast("array<long>")).alias("part")
    dealt = dealt.unionByName(counts.select("leaf", every), allowMissingColumns=True)  # also empty ones
    dealt.groupBy("leaf", "part").applyInArrow(run, "leaf long, part long").write.parquet(f"{folder}-written")
    return files


def _stored(uri: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a file, a bounded number at a time."""
    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(path) as file:
        table = pa.ipc.open_file(file).read_all()
    for at in range(0, table.num_rows, BLOCK_ROWS):
        rows = table.slice(at, BLOCK_ROWS).combine_chunks()
        yield rows.column("vec_id").to_numpy(), _matrix(rows.column("vector").combine_chunks())


class Neighbours:
    """The best so far of a block of queries."""

    def __init__(self, names: np.ndarray, points: np.ndarray, k: int) -> None:
        self.names, self.points, self.k = names, points, k
        self.ids = [np.zeros(0, np.int64) for _ in names]
        self.scores = [np.zeros(0) for _ in names]
        self.worst = np.full(len(names), -np.inf)  # of k neighbours
        self.length = np.linalg.norm(points, axis=1)

    def meet(self, who: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        """Compare the queries at the places ``who`` with stored vectors."""
        rough = self.points[who] @ points.T
        # A product may be off by its rounding, and the exact one must not be missed for it.
        slack = 1e-14 * points.shape[1] * self.length[who] * np.linalg.norm(points, axis=1).max()
        may = rough >= (self.worst[who] - slack)[:, None]
        may &= ids != self.names[who][:, None]
        for row in np.flatnonzero(may.any(axis=1)):
            query, some = who[row], np.flatnonzero(may[row])
            exact = _scores(self.points[query : query + 1], points[some])[0]
            joint = np.concatenate([self.ids[query], ids[some]])
            scores = np.concatenate([self.scores[query], exact])
            best = _best(scores, joint, self.k)
            self.ids[query], self.scores[query] = joint[best], scores[best]
            if len(best) == self.k:
                self.worst[query] = scores[best[-1]]


def search(
    index: Index,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's nearest found, its own row left out.

    Equal scores go by the smaller id. Rows that repeat an id are candidates each; of queries that repeat
    an id, the one whose vector comes first in order asks. Queries without a usable vector have no rows.
    A query whose leaves hold fewer than ``k`` candidates goes on to all others.
    """
    tree, most, files = index.tree, index.leaves_visited, index.files
    leaves = os.path.join(index.folder, "leaves")
    spark = queries.sparkSession
    shared = spark.sparkContext.broadcast(tree)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = [shared.value.visits(point, 1)[0] for point in _matrix(batch.column(1))]
            yield pa.record_batch(
                [*batch.columns, pa.array(home, pa.int64())], names=["query_id", "vector", "home"]
            )

    def found(names: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        own = Neighbours(names, points, k)
        place = np.full((len(names), tree.leaves), tree.leaves)
        for row, point in enumerate(points):
            order = shared.value.visits(point, most)
            place[row, order] = np.arange(len(order))
        urgent = [leaf for leaf in np.argsort(place.mean(axis=0), kind="stable").tolist() if leaf in files]
        for asked in (True, False):
            for leaf in urgent:
                visits = place[:, leaf] < tree.leaves
                who = np.flatnonzero(visits if asked else ~visits & (own.worst == -np.inf))
                for part in range(files[leaf]) if len(who) else ():
                    for ids, stored in _stored(f"{leaves}/leaf-{leaf}-{part}.arrow"):
                        own.meet(who, ids, stored)
        counts = [len(x) for x in own.ids]
        ranks = [np.arange(1, count + 1, dtype=np.int32) for count in counts]
        columns = [np.repeat(names, counts), *(np.concatenate(x) for x in (ranks, own.ids, own.scores))]
        return pa.record_batch([pa.array(x) for x in columns], names=["query_id", "rank", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                rows = batch.slice(at, QUERY_BLOCK)
                yield found(rows.column(0).to_numpy(), _matrix(rows.column(1)))

    asked = (
        usable(queries, id_column, vector_column, index.dimensions)
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .select(F.col("vec_id").alias("query_id"), "vector")
    )
    path = os.path.join(scratch_dir(spark, "queries"), "asked")
    asked.mapInArrow(homes, "query_id long, vector array<double>, home long").write.parquet(path)
    dealt = spark.read.parquet(path)
    tasks = max(-(-dealt.count() // QUERY_BLOCK), 1)
    return (
        dealt.repartitionByRange(tasks, "home", "query_id")
        .sortWithinPartitions("home", "query_id")
        .select("query_id", "vector")
        .mapInArrow(tidy(run), "query_id long, rank int, vec_id long, score double")
    )
