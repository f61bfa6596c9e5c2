"""The registered text queries against their SQL, and the pipeline against its stages done plainly."""

import zlib
from pathlib import Path

import pytest
from llm_samples import components_of
from test_texts import brute_hits

import corpus_pipeline
from seismic_lake.llm import pii, toxicity
from seismic_lake.llm.queries import ORACLES, QUERIES, table
from workload.compare import connect, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="supplied tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) >= table(spark, SF, "documents").count()
    if name in ORACLES:
        cursor = con.execute(ORACLES[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(df.columns) == sorted(columns)
        assert got == rows_of(columns, cursor.fetchall())


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    state = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]

    def kept(name):
        nonlocal docs
        docs = stages[name](spark, docs, SF)
        assert docs.columns == columns
        return {r["doc_id"]: r["text"] for r in docs.collect()}

    model = toxicity.fit(docs, table(spark, SF, "labels"))
    rejected = {r["doc_id"] for r in toxicity.score(docs, model).collect() if r["predicted"]}
    after = kept("toxicity")
    assert after == {i: t for i, t in state.items() if i not in rejected}
    ids = sorted(after)
    groups = components_of([after[i] for i in ids], 5)
    state, after = after, kept("near_dedup")
    assert after == {i: state[i] for k, i in enumerate(ids) if groups[k] == k}
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    state, after = after, kept("decontamination")
    assert after == {i: t for i, t in state.items() if not brute_hits(t, items)[1]}
    state, after = after, kept("pii")
    assert after == {i: pii.redacted(t) for i, t in state.items()}
    packed = stages["packing"](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(after) and zlib.crc32(b"") == 0
