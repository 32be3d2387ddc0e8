"""Registered queries without SQL, run as they are registered, against brute force."""

import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest

from shopmarts.llm import queries, toxicity
from shopmarts.llm.tokenizing import Encoder
from shopmarts.session import tune

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def found(spark):
    def run(name):
        return queries.QUERIES[name](tune(spark), FOLDER).collect()

    return run


@pytest.fixture(scope="module")
def given(spark):
    return queries.table(spark, FOLDER, "documents").collect()


def ids_of(name, texts, end):
    library = Encoder(public_tokenizers.path(name)).library
    return [array("I", [*library.encode(t or "", add_special_tokens=False).ids, end]).tobytes() for t in texts]


def test_op2_finds_nearly_all_nearest(spark, found):
    rows = queries.table(spark, FOLDER, "embeddings").select("vec_id", "embedding").collect()
    names = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], float)
    own = {}
    for r in found("op2_kmeans_tree"):
        own.setdefault(r.query_id, {})[r.vec_id] = r.score
    asked = [i for i, name in enumerate(names) if name % 20 == 0]
    assert set(own) == {names[i] for i in asked}
    hits = total = 0
    for i in asked:
        scores = vectors @ vectors[i]
        others = np.flatnonzero(names != names[i])
        nearest = others[np.lexsort((names[others], -scores[others]))[:20]]
        listed = own[names[i]]
        assert len(listed) == len(nearest)
        hits += len(set(listed) & set(names[nearest].tolist()))
        total += len(nearest)
    assert hits / total >= 0.9


def test_op3_stores_every_documents_ids(given, found):
    ordered = sorted(given, key=lambda r: (r.doc_id, r.text is not None, r.text or ""))
    wanted, at = [], 0
    for r, ids in zip(ordered, ids_of("word_bpe_49k.json", [r.text for r in ordered], 2), strict=True):
        wanted.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    rows = found("op3_repair_ids")
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == sorted(wanted) and wanted


def test_op5_replaces_only_where_it_says_so(given, found):
    before = {r.doc_id: r.text for r in given}
    rows = found("op5_pii_pseudonyms")
    assert {r.doc_id for r in rows} == set(before) and len(rows) == len(given)
    assert all((r.text != before[r.doc_id]) <= (r.n_replaced > 0) for r in rows)
    assert any(r.text != before[r.doc_id] for r in rows)


def test_op7_scores_every_document(spark, given, found):
    model = toxicity.train(*(queries.table(spark, FOLDER, name) for name in ("documents", "labels")))
    automaton = model.automaton()
    wanted = {
        r.doc_id: model.probability(np.array([toxicity.features(toxicity.fold(r.text), automaton)]))[0]
        for r in given
    }
    rows = found("op7_toxicity")
    assert len(rows) == len(given)
    assert all(r.score == pytest.approx(wanted[r.doc_id]) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_op8_tells_the_held_out_languages(given, found):
    rows = found("op8_language")
    assert len(rows) == len(given)
    lang = {r.doc_id: r.lang for r in given}
    judged = [lang[r.doc_id] == r.lang_pred for r in rows if r.held_out and lang[r.doc_id]]
    assert judged and sum(judged) / len(judged) > 0.9


def test_op10_packs_every_documents_ids(given, found):
    texts = {r.doc_id: r.text for r in given}
    ids = dict(zip(texts, ids_of("byte_bpe_50k.json", texts.values(), 0), strict=True))
    at = dict.fromkeys(ids, 0)
    sequences = {}
    for r in sorted(found("op10_cost_balanced_packing"), key=lambda r: r.start):
        own = ids[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(own) // 4
        at[r.doc_id] += r.length
        assert r.ids_crc32 == zlib.crc32(own[4 * r.start : 4 * at[r.doc_id]])
        sequences.setdefault(r.sequence_id, []).append(r)
    assert at == {i: len(own) // 4 for i, own in ids.items()} and at
    assert all(sum(r.length for r in own) == own[0].sequence_length for own in sequences.values())
