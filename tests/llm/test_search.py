"""The k-means tree against brute force."""

import numpy as np
import pytest

from shopmarts.llm import ann
from shopmarts.llm.shipping import shipped

SCHEMA = "vec_id long, embedding array<float>, score double, leaf long, rank int"


def table(spark, rows):
    return shipped(spark).createDataFrame([(i, v, 0.0, 0, 0) for i, v in rows], SCHEMA)


def exact(rows, query, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if usable(v)]
    own = [v for i, v in good if i == query][0]
    scored = sorted((-float(own @ v), i) for i, v in good if i != query)
    return [(i, -s) for s, i in scored[:k]]


def usable(v):
    return bool(v) and None not in v and np.isfinite(v).all() and any(v) and len(v) == 8


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, 8))
    points = centres[rng.integers(0, 12, 1500)] * rng.uniform(0.5, 2, (1500, 1)) + rng.normal(size=(1500, 8)) * 0.3
    found = [(i, [float(x) for x in np.float32(p)]) for i, p in enumerate(points)]
    same = found[20][1]
    found += [(2000 + i, same) for i in range(400)]
    nan, inf = float("nan"), float("inf")
    found += [(5000, None), (5020, []), (5040, [0.0] * 8), (5060, [nan] * 8), (5080, [inf] * 8), (5100, [1.0, None] * 4)]
    return found + [(5120, [1.0] * 3)]


@pytest.mark.parametrize("block", [4096, 64])
def test_recall_scores_and_order(spark, rows, monkeypatch, block):
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 40)
    monkeypatch.setattr(ann, "BLOCK_ROWS", block)
    vectors = table(spark, rows).repartition(4)
    queries = vectors.where("vec_id % 20 = 0")
    index = ann.build(vectors, queries, k=20)
    assert 1 < index.leaves_visited < index.tree.leaves and index.recall >= ann.RECALL
    assert index.vectors.count() == 1900
    found = {}
    for r in ann.search(index, queries, k=20).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == {i for i, v in rows if i % 20 == 0 and usable(v)}
    hits = total = 0
    for query, own in found.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, 21)) and query not in [v for _, v, _ in own]
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))
        wanted = exact(rows, query, 20)
        scores = dict(exact(rows, query, len(rows)))
        assert all(abs(scores[v] - s) < 1e-12 for _, v, s in own)
        hits += len({v for _, v, _ in own} & {v for v, _ in wanted})
        total += 20
    assert hits / total >= 0.9
    # Of 400 equal vectors the smallest ids are found.
    assert [v for _, v, _ in found[20] if v >= 2000] == [v for v, _ in exact(rows, 20, 20) if v >= 2000]


def test_few_or_no_vectors(spark):
    one = table(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0])])
    found = ann.search(ann.build(one, one, k=20), one, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [
        (0, 1, 1), (0, 2, 20), (1, 1, 0), (1, 2, 20), (20, 1, 0), (20, 2, 1)
    ]
    none = one.limit(0)
    assert ann.search(ann.build(none, none, k=20), none, k=20).count() == 0
    assert ann.search(ann.build(one, none, k=20), none, k=20).count() == 0


def test_best_bin_first_visits_every_leaf_once_nearest_first():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(2000, 4))
    tree = ann.fit(points, 10.0)
    visited = tree.visits(points[0], tree.leaves)
    assert sorted(visited) == list(range(tree.leaves)) and tree.visits(points[0], 3) == visited[:3]
    assert set(tree.leaf_of(points)) <= set(visited)
