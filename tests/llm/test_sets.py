"""Decontamination and the Jaccard join against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from shopmarts.llm import decontaminate, jaccard
from shopmarts.llm.components import components
from tests.llm.conftest import ODD

ITEMS = "item_id long, text string, window string, row string"


def some_words(rng, count, size=30):
    return [f"w{rng.randint(0, size)}" for _ in range(count)]


def contamination_of(text, items):
    words = decontaminate.WORD.findall((text or "").lower())
    hit, named = set(), set()
    for name, item in items:
        own = decontaminate.WORD.findall((item or "").lower())
        n = min(13, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit.update(range(i, i + n))
                named.add(str(name))
    digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
    return len(words), len(hit), len(named), digest, bool(hit) and 20 * len(hit) >= len(words)


def test_contamination_is_that_of_brute_force(spark, documents):
    rng = random.Random(3)
    items = [(i, " ".join(some_words(rng, rng.choice([1, 2, 3, 5, 12, 13, 14, 20, 40]), 400))) for i in range(25)]
    items += [(30, None), (31, ""), (32, "a a a a a a a a a a a a a a a"), (33, items[8][1]), (8, items[8][1])]
    texts = []
    for _ in range(60):
        words = some_words(rng, rng.randint(0, 300), 400)
        for _ in range(rng.randint(0, 3)):
            own = (rng.choice(items)[1] or "").split()
            at = rng.randint(0, len(words))
            words[at:at] = own[rng.randint(0, 2) :]
        texts.append(rng.choice([" ", ", ", "\n"]).join(words).title())
    texts += [*ODD, "a " * 500, texts[0]]
    found = decontaminate.contamination(
        documents(*texts).repartition(3),
        spark.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS),
    ).collect()
    assert len(found) == len(texts)
    for row in found:
        wanted = contamination_of(texts[row.doc_id], items)
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated) == wanted
    assert any(row.contaminated for row in found) and not all(row.contaminated for row in found)


def test_clean_documents_stay(spark, documents):
    items = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(20)), "x", "y")], ITEMS)
    docs = documents("clean text", " ".join(f"Q{i}" for i in range(20)), None, (None, "no id"))
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["0", "2", "None"]
    for some in (items.limit(0), items):
        assert decontaminate.contamination(docs.limit(0), some).count() == 0
    assert decontaminate.contamination(docs, items.limit(0)).where("contaminated").count() == 0


def test_each_row_is_judged_by_its_own_text(spark, documents):
    """Rows without an id, and rows that share one; the id column may have any name."""
    dirty = " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame([(1, dirty, "x", "y")], ITEMS)
    docs = documents((None, dirty), (None, "no id"), (1, dirty), (1, "same id"), (1, "same id"), (2, None))
    for rows, name in ((docs, "doc_id"), (docs.withColumnRenamed("doc_id", "name"), "name")):
        kept = decontaminate.clean(rows, items, id_column=name)
        assert kept.columns == rows.columns
        assert sorted(str((r[name], r.text)) for r in kept.collect()) == sorted(
            str(x) for x in [(None, "no id"), (1, "same id"), (1, "same id"), (2, None)]
        )
        assert decontaminate.clean(rows.limit(0), items, id_column=name).count() == 0


def test_one_row_of_each_group_stays(spark, documents):
    """Also where rows share the smallest id; rows without an id stay."""
    copy = "a b c d e f g"
    docs = documents((1, copy), (1, copy), (2, copy), (3, "other x"), (3, "other"), (None, copy), (None, copy))
    for rows, name in ((docs, "doc_id"), (docs.withColumnRenamed("doc_id", "name"), "name")):
        kept = jaccard.deduplicated(rows.repartition(3), id_column=name)
        assert kept.columns == rows.columns
        assert sorted(str((r[name], r.text)) for r in kept.collect()) == sorted(
            str(x) for x in [(1, copy), (3, "other"), (None, copy), (None, copy)]
        )
    assert jaccard.deduplicated(docs.limit(0)).count() == 0


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(decontaminate._LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1)))


def groups_of(texts):
    sets = [sets_of(t) for t in texts]
    least = list(range(len(texts)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                x, y = sorted((find(i), find(j)))
                least[y] = x
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = f"n{rng.randint(0, 10**6)}"
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, f"n{rng.randint(0, 10**6)}")
    return words


@pytest.mark.parametrize("cell,small", [(400_000, 24), (400_000, 2), (900, 2)])
def test_components_are_those_of_brute_force(spark, documents, monkeypatch, cell, small):
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", cell)
    monkeypatch.setattr(jaccard, "SMALL_TILE", small)
    rng = random.Random(5)
    licence = some_words(rng, 60, 10**6)
    texts = []
    for size in (3, 6, 20, 64, 85, 256, 300):
        base = some_words(rng, size, 10**6)
        for _ in range(8):
            texts.append(" ".join(edited(rng, base, rng.randint(0, max(1, size // 15)))))
    base = some_words(rng, 150, 10**6)  # a chain: every text is the former with a few more edits
    for _ in range(25):
        base = edited(rng, base, 3)
        texts.append("\n".join(base))
    texts += [" ".join(licence + some_words(rng, rng.randint(5, 60), 10**6)) for _ in range(25)]
    texts += [*ODD, *ODD, texts[0].upper(), "a b c", "a  b\tc", "a b"]
    rng.shuffle(texts)
    found = jaccard.near_duplicates(documents(*texts).repartition(4)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {
        (i, *x) for i, x in enumerate(groups_of(texts))
    }


def test_repeated_rows_ids_and_missing_ids(documents):
    long = " ".join(f"a{i}" for i in range(30))
    docs = documents((5, long), (5, long), (5, "other words of the same id"), (7, "Other words of the same id"),
                     (9, long), (None, long), (3, None), (3, ""))
    found = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect())
    assert found == sorted(
        [("5", 26, 5), ("5", 26, 5), ("5", 2, 5), ("7", 2, 5), ("9", 26, 5), ("None", 26, None), ("3", 0, 3), ("3", 0, 3)]
    )
    kept = jaccard.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {5, None, 3}
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_a_tile_of_similar_documents_returns_a_forest():
    base = np.arange(400, dtype=np.uint64) * np.uint64(2654435761)
    sets = [np.sort(np.append(base[:-3], base[-1] + np.uint64(i + 1))) for i in range(60)]
    flags = np.ones(60, bool)
    links = jaccard.cell_links(sets, np.arange(60), np.full(60, -1), flags, flags)
    assert len(links) == 59
    assert jaccard.cell_links(sets, np.zeros(60, int), np.full(60, -1), flags, flags) == []


def test_bitmaps_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for n in (1, 3, 15, 16, 17, 60, 250):
        for _ in range(50):
            one = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            other = np.unique(np.concatenate([one[: rng.integers(0, n + 1)], rng.integers(0, 1 << 63, rng.integers(0, n // 3 + 1), dtype=np.uint64)]))
            if len(other) and jaccard.similar(one, other):
                assert jaccard.may_link(jaccard.signature(one), len(one), jaccard.signature(other), len(other))
    far = [np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(2)]
    assert not jaccard.may_link(*(x for s in far for x in (jaccard.signature(s), len(s))))


def test_overlap_and_threshold():
    a, b = np.arange(0, 40, dtype=np.uint64), np.arange(10, 50, dtype=np.uint64)
    assert jaccard.overlap(a, b) == 30 and jaccard.overlap(a, a[:0]) == 0
    assert jaccard.similar(a[:6], a[:8]) and not jaccard.similar(a[:5], a[:7])
    assert not jaccard.similar(a[:0], a[:0])


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (2, 1), (1, 2), (None, 4)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 161)) and all(found[i] == 7 for i in range(7, 40))
    assert found[1] == found[2] == 1 and 3 not in found and 4 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
