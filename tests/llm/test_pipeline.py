"""The pipeline's stages against plain checks of what each must leave."""

import numpy as np
import pytest

import corpus_pipeline as P
from stellate.llm import staging

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(staging.stage(stage(spark, out[-1], SF), "test"))
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_each_stage_leaves_what_it_should(spark, stages):
    from test_decontaminate import brute
    from test_repeats import covered
    from test_simhash import brute_components, brute_fingerprint
    docs = [{r.doc_id: r.text for r in s.collect()} for s in stages[:-1]]
    assert set(docs[1]) <= set(docs[0])
    ids = sorted(docs[1])
    classes = brute_components([brute_fingerprint(docs[1][i]) for i in ids])
    assert set(docs[2]) == {ids[c] for c in classes}
    ids = sorted(docs[2])
    texts = [docs[2][i].encode() for i in ids]
    for i, t, gone in zip(ids, texts, covered(texts, 200)):
        left = bytes(b for b, g in zip(t, gone) if not g)
        assert docs[3][i] == left.decode("utf-8", "ignore")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    ids = sorted(docs[3])
    marks = brute([docs[3][i] for i in ids], bench)
    assert set(docs[4]) == {i for i, (n, hit, _) in zip(ids, marks) if not (hit and 20 * hit >= n)}


def test_packed_ids_round_trip(stages):
    from test_packing import library_ids
    texts = {r.doc_id: r.text for r in stages[-2].collect()}
    got = {}
    for r in stages[-1].collect():
        got.setdefault(r.doc_id, {})[r.start] = np.frombuffer(bytes(r.ids), "<u4")
    for (doc, _), ids in zip(texts.items(), library_ids(texts.values())):
        assert np.concatenate([got[doc][s] for s in sorted(got[doc])]).tolist() == ids.tolist()


def test_edge_rows_pass_through_every_stage(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in P.STAGES:
            docs = staging.stage(stage(spark, docs, SF), "edge")
        docs.collect()


def test_run_gives_the_last_stage(spark, stages):
    assert P.run(spark, SF).count() == stages[-1].count()


def test_staged_tables_can_be_cleared(spark):
    df = staging.stage(spark.range(3), "short-lived")
    assert df.count() == 3
    staging.clear_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(df.inputFiles()[0]).count()
