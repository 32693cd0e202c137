import math

import numpy as np

from stellate.llm import resample as R
from stellate.llm.kernels import LOWER_VALUES, mix, tokens, word_hashes
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_log_weights_against_brute_force(spark):
    rows = [(1, "good words here. good"), (2, "bad bad words!!"), (3, "other Words here"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    good = {1, 3}

    def grams(text):
        data = np.frombuffer((text or "").encode(), np.uint8)
        s, e, _ = tokens(data, np.array([0, len(data)]))
        h = word_hashes(data, s, e, LOWER_VALUES)
        return [[int(x) % R.BUCKETS for x in h], [int(x) % R.BUCKETS for x in mix(h[:-1] * np.uint64(3) + h[1:])]]

    raw, target = [{}, {}], [{}, {}]
    for i, t in rows:
        for o, found in enumerate(grams(t)):
            for b in found:
                raw[o][b] = raw[o].get(b, 0) + 1
                target[o][b] = target[o].get(b, 0) + (i in good)
    want = {}
    for i, t in rows:
        w = 0.0
        for o, found in enumerate(grams(t)):
            scale = sum(target[o].values()) / max(sum(raw[o].values()), 1)
            w += sum(math.log((target[o][b] + R.SHRINK[o]) / (raw[o][b] * scale + R.SHRINK[o])) for b in found)
        want[i] = w
    got = {r.doc_id: r.log_weight for r in R.log_weights(docs, R.log_ratios(docs, R.targets(labels))).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_kth_largest_is_exact(spark):
    x = np.random.default_rng(1).normal(0, 1e3, 5000).tolist() + [7.0] * 300
    df = spark.createDataFrame([(v,) for v in x] + [(None,)], "x double")
    order = sorted(x, reverse=True)
    for k in (1, 2, 100, 2500, 5299, 5300):
        assert R.kth_largest(df, "x", k, few=16) == order[k - 1]
    assert R.kth_largest(df, "x", 5301) is None
    assert R.kth_largest(spark.createDataFrame([(1.0,)] * 9000, "x double"), "x", 4500) == 1.0


def test_sample_keeps_the_good_and_leaves_the_bad(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    drawn = {r.doc_id for r in QUERIES["op9_importance_resampling"](spark, SF).collect()}
    marks = {r.doc_id: r for r in labels.collect()}
    good = [i for i, r in marks.items() if r.quality == 1 and r.toxic == 0]
    low = [i for i, r in marks.items() if r.quality == 0]
    assert np.mean([i in drawn for i in good]) > 0.9 and np.mean([i in drawn for i in low]) < 0.25
    assert len(drawn) == round(docs.count() * len(good) / len(marks))


def test_gumbel_top_k_draws_by_weight(spark):
    docs = spark.createDataFrame([(i, "even odds") for i in range(4000)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    a = {r.doc_id for r in R.resample(docs, labels, k=1000).where("selected").collect()}
    b = {r.doc_id for r in R.resample(docs, labels, k=1000, seed=8).where("selected").collect()}
    assert len(a) == len(b) == 1000 and 150 < len(a & b) < 350


def test_edges(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = R.resample(edge_docs, labels).collect()
    assert len(got) == len(edge_rows) and {r.log_weight for r in got if r.doc_id in (2, 3, 10)} == {0.0}
    assert len({r.key for r in got if r.doc_id == 13}) == 1
    none = labels.limit(0)
    assert R.resample(edge_docs, none).where("NOT selected").count() == 0
    assert R.resample(no_docs, labels).count() == 0


def test_targets_are_counted_up_to_the_bound(spark):
    docs = spark.createDataFrame([(i, f"w{i} same") for i in range(400)], "doc_id long, text string")
    known = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, target int")
    every = R.log_ratios(docs, known)
    assert np.array_equal(every, R.log_ratios(docs, known, 400))
    some = R.log_ratios(docs, known, 100)
    assert some.shape == every.shape and not np.array_equal(every, some)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    assert R.resample(docs, labels, target_rows=100).count() == 400
