"""The registered queries against SQL, and the pipeline's stages against brute force."""

import inspect
import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from shopmarts.llm import queries, toxicity
from shopmarts.session import tune
from tests.compare import compare, duck
from tests.llm.test_sets import contamination_of, groups_of

FOLDER = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    names = entry.queries()
    assert set(queries.QUERIES) <= set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](tune(spark), FOLDER), duck(FOLDER), queries.ORACLE[name]) == []


def test_stages_take_effect(spark, tmp_path):
    docs = queries.table(spark, FOLDER, "documents")
    benchmark = [(r.item_id, r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "jaccard_join", "decontaminate", "pii", "packing"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for f in stages.values())
    before = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns

    def step(name):
        nonlocal docs
        path = os.path.join(tmp_path, name)
        stages[name](spark, docs, FOLDER).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        return {r.doc_id: r.text for r in docs.collect()}

    found = step("toxicity")
    model = toxicity.train(
        queries.table(spark, FOLDER, "documents"), queries.table(spark, FOLDER, "labels")
    )
    automaton = model.automaton()
    score = {
        i: model.probability(toxicity.np.array([toxicity.features(toxicity.fold(t), automaton)]))[0]
        for i, t in before.items()
    }
    assert set(found) == {i for i in before if score[i] < 0.3} and 0 < len(found) < len(before)

    names = sorted(found)
    groups = groups_of([found[i] for i in names])
    kept = {names[group] for _, group in groups}
    before, found = found, step("jaccard_join")
    assert set(found) == kept and len(found) < len(before)

    dirty = {i for i, t in found.items() if contamination_of(t, benchmark)[4]}
    before, found = found, step("decontaminate")
    assert set(found) == set(before) - dirty and dirty

    before, found = found, step("pii")
    assert set(found) == set(before)
    assert any(before[i] != found[i] for i in found)
    assert all(before[i] == found[i] for i in found if not any(c in before[i] for c in "0123456789@"))
    pieces = stages["packing"](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in pieces} == set(found)
