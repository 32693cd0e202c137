import zlib

import numpy as np
from pyspark.sql import functions as F

from stellate.llm import langid as L
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    got = QUERIES["op7_ppm_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97


def test_training_never_sees_held_out_documents(spark):
    rows = [(i, "abc abc abc", "aa") for i in range(40)]
    rows = [(i, t, lang) if zlib.crc32(str(i).encode()) % 4 != 2 else (i, "zzzz", "zz") for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in L.training_texts(docs).collect()} == {"aa"}
    assert L.train(docs).langs == ["aa"]


def test_sample_is_bounded_and_repeats_count_once(spark):
    docs = spark.createDataFrame([(1, "same", "x")] * 50 + [(i, f"text {i}", "x") for i in range(100, 200)],
                                 "doc_id long, text string, lang string")
    assert L.training_texts(docs, rows=20).count() <= 20


def test_copies_leave_a_full_sample(spark):
    other = spark.createDataFrame([(i, f"text {i}", "x") for i in range(100)], "doc_id long, text string, lang string")
    least = L.training_texts(other, rows=100).selectExpr("text", "xxhash64(text) AS h").orderBy("h").first().text
    copies = spark.createDataFrame([(i, bytes(least).decode(), "x") for i in range(1000, 1300)], other.schema)
    got = [bytes(r.text) for r in L.training_texts(other.union(copies), rows=20).collect()]
    assert len(got) == len(set(got)) == 20 and bytes(least) in got


def test_more_languages_than_64_are_all_modelled(spark):
    rows = [(100 * k + i, f"{chr(0x4e00 + k)}{chr(0x4e00 + k)} {k:03d} {i}", f"l{k:03d}") for k in range(70) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    truth = {r[0]: r[2] for r in rows}
    got = L.identify(docs).collect()
    assert len(got) == len(rows) and np.mean([r.lang_pred == truth[r.doc_id] for r in got]) > 0.97


def test_languages_of_long_texts_are_learned(spark):
    rows = [(i, f"alpha beta {i} " * (30 + i), "long") for i in range(8)] + [(20 + i, f"gamma delta {i}", "short") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = L.training_texts(docs, rows=3, max_bytes=400).collect()
    sizes = sorted(len(r.text) for r in got if r.lang == "long")
    known = sorted(len(t) for i, t, lang in rows if lang == "long" and zlib.crc32(str(i).encode()) % 4 != 2)
    assert sizes == known[:len(sizes)] and sizes and sum(sizes) <= 1200
    assert [len(r.text) for r in L.training_texts(docs.where("doc_id = 0"), rows=3, max_bytes=10).collect()] == [known[0]]
    assert {r.doc_id: r.lang_pred for r in L.identify(docs, rows=3, max_bytes=400).collect()}[7] == "long"


def test_every_context_of_the_sample_is_kept():
    gram = np.unique(np.random.default_rng(2).integers(1, 200, (60_000, 4)) @ np.array([1 << 24, 1 << 16, 1 << 8, 1]))
    model = L.Model(["x"], np.zeros(len(gram), np.int64), gram, np.ones(len(gram), np.int64))
    A, s = model.classes, [model.of_byte[gram >> k & 0xFF] for k in (24, 16, 8)]
    nodes = model.node[(s[0] * A + s[1]) * A + s[2]]
    assert len(np.unique(nodes)) == len(np.unique(gram >> 8)) > 1 << 14
    total = np.exp2(-model.cost[0][nodes[:50, None] * np.int64(A) + np.arange(A)] / L.STEP).sum(1)
    assert np.allclose(total, 1, atol=0.01)


def test_every_lettered_document_stays(spark):
    texts = ["a", "no", "one two", "x 1", "é", "日", "1 2 3", "", "?!", None]
    rows = [(100 * k + i, f"the same words {i}", f"l{k}") for k in range(4) for i in range(8)]
    rows += [(1000 + i, t, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in L.keep_identified(docs).collect()}
    assert kept == {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}


def test_probabilities_of_a_context_add_up():
    p = L._escaped(np.array([[3.0, 1.0, 0.0, 0.0], [0.0, 0.0, 0.0, 0.0], [1.0, 1.0, 1.0, 1.0]]),
                   np.array([[0.25, 0.25, 0.25, 0.25]] * 3))
    assert np.allclose(p.sum(1), 1) and np.allclose(p[0], [0.5, 1 / 6, 1 / 6, 1 / 6])


def test_code_lengths_against_a_byte_by_byte_walk():
    rng = np.random.default_rng(4)
    text = bytes(rng.choice(list(b"abc d"), 400).astype(np.uint8).tolist())
    b = np.concatenate([np.zeros(3, np.int64), np.frombuffer(text, np.uint8).astype(np.int64)])
    gram, n = np.unique(b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:], return_counts=True)
    model = L.Model(["x", "y"], np.repeat([0, 1], len(gram)), np.concatenate([gram, gram]), np.concatenate([n, n]))
    probe = np.frombuffer(b"abca zzd", np.uint8)
    got = model.lengths(np.concatenate([probe, probe]), np.array([0, 8, 8, 16]))
    assert got[1].tolist() == [0, 0] and np.allclose(got[0], got[2])
    A, total = model.classes, 0
    seen = [model.other] * 3
    for c in model.of_byte[probe]:
        total += model.cost[0][model.node[(seen[0] * A + seen[1]) * A + seen[2]] * A + c]
        seen = [*seen[1:], int(c)]
    assert np.isclose(got[0][0], total / L.STEP)


def test_edges(spark, edge_docs, edge_rows, no_docs):
    got = L.identify(edge_docs).collect()
    assert len(got) == len(edge_rows)
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert und == {2, 3, 10, 11} and all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = L.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and not und & {r.doc_id for r in kept.collect()}
    assert L.identify(no_docs).count() == 0 and L.keep_identified(no_docs).count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}
