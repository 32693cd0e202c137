import hashlib
import re
from collections import Counter

import numpy as np

from stellate.llm import weighted_sampling as W
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def jaccard(a, b):
    x, y = (Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in (a, b))
    return sum((x & y).values()) / max(sum((x | y).values()), 1) if x or y else 1.0


def test_query_against_exact_jaccard(spark, document_rows):
    got = {r.doc_id: r for r in QUERIES["op2_weighted_sampling"](spark, SF).collect()}
    rows = sorted(document_rows)
    edit_error, next_error, fps = [], [], {}
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert fps.setdefault(text, r.fingerprint) == r.fingerprint
        edit_error.append(r.near_edited - jaccard(text, edited))
        next_error.append(r.near_next - jaccard(text, after))
    for e in (edit_error, next_error):
        assert abs(np.mean(e)) < 0.02 and np.std(e) < 0.08
    assert len(got) == len(rows)


def test_collisions_follow_weights(spark):
    a, b = "x " * 8 + "y", "x " * 2 + "y z"  # sums of minima 3, of maxima 10
    fp = [r.fingerprint for r in W.fingerprints(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string"), samples=512)
          .orderBy("doc_id").collect()]
    same = sum(fp[0][i:i + 8] == fp[1][i:i + 8] for i in range(0, 4096, 8)) / 512
    assert abs(same - 0.3) < 0.07


def test_edges(edge_docs, edge_rows, no_docs):
    got = W.edit_robustness(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by_id = {r.doc_id: r for r in got}
    zero = W.zero_fingerprint()
    assert by_id[2].fingerprint == by_id[3].fingerprint == by_id[10].fingerprint == zero
    assert by_id[2].near_next == 1.0 and by_id[2].near_edited == 1.0  # empty beside empty
    assert by_id[1].fingerprint == by_id[5].fingerprint and by_id[1].near_next == 0.0
    assert len({(r.fingerprint, r.edited_sha256) for r in got if r.doc_id == 13}) == 1
    assert W.edit_robustness(no_docs).count() == 0


def test_a_single_document_follows_itself(spark):
    r = W.edit_robustness(spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")).first()
    assert r.near_next == 1.0


def test_no_python_on_the_main_path(documents):
    plan = W.edit_robustness(documents)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_following_is_the_global_order(spark):
    ids = spark.createDataFrame([(i * 37 % 1009 - 300,) for i in range(1009)], "k long")
    got = {r.k: r.next_k for r in W.following(ids).collect()}
    order = sorted(got)
    assert len(order) == 1009 and all(got[a] == b for a, b in zip(order, order[1:] + order[:1]))


def test_texts_of_a_row_share_draws_but_not_samples(spark):
    """Side by side, texts get the parts each gets alone, whether a word weighs the same in both or not; one value a sample serves both."""
    texts = ["a a b c d", "a b b c e e e"]
    rows = spark.createDataFrame([(1, *texts), (2, texts[0], texts[0]), (3, texts[1], "")], "k long, x string, y string")
    both = W.signatures(rows, ["k"], ["x", "y"])
    got = {r.k: (r.x, r.y) for r in both.select("k", W.joined(0).alias("x"), W.joined(1).alias("y")).collect()}
    alone = [r.fingerprint for r in W.fingerprints(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == {1: tuple(alone), 2: (alone[0], alone[0]), 3: (alone[1], W.zero_fingerprint())}
    assert both._jdf.queryExecution().optimizedPlan().toString().count("FLOOR(") == W.BLOCK
