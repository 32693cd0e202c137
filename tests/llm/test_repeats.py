"""Substring dedup (words) and suffix-array dedup (bytes) against brute force."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from stellate.llm import substrings, suffixes
from stellate.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def covered(seqs, width):
    """For each sequence, which units a window covers that starts in more than one place."""
    seen = Counter(s[i:i + width] for s in seqs for i in range(len(s) - width + 1))
    out = []
    for s in seqs:
        turn = np.zeros(len(s) + 1, np.int64)
        for i in range(len(s) - width + 1):
            if seen[s[i:i + width]] > 1:
                turn[i] += 1
                turn[i + width] -= 1
        out.append(np.cumsum(turn)[:len(s)] > 0)
    return out


def runs(gone):
    return int(np.sum(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))


def small(rows):
    """Without the very long text, which brute force can't take."""
    return [r for r in rows if r[0] != 4]


@pytest.mark.parametrize("name", ["op4_fm_index_decontamination", "op5_rabin_karp_substrings", "op6_suffix_merge_sort",
                                  "op8_host_reputation"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, res.fetchall()))


@pytest.mark.parametrize("window", [35, 5, 1])
def test_words_against_brute_force(spark, edge_docs, edge_rows, window):
    rows = small(edge_rows)
    seqs = [tuple((r[1] or "").encode().split()) for r in rows]
    want = sorted(str((r[0], len(s), int(g.sum()), b" ".join(w for w, x in zip(s, g) if not x).decode()))
                  for r, s, g in zip(rows, seqs, covered(seqs, window)))
    docs = edge_docs.where("doc_id <> 4 OR doc_id IS NULL")
    got = substrings.dedup_substrings(docs, window=window).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept_text)) for r in got) == want
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in got)


@pytest.mark.parametrize("length,crowd", [(200, 64), (60, 64), (60, 2), (9, 64)])
def test_bytes_against_brute_force(spark, edge_docs, edge_rows, length, crowd):
    rows = small(edge_rows)
    seqs = [(r[1] or "").encode() for r in rows]
    want = sorted(str((r[0], len(s), int(g.sum()), runs(g), bytes(b for b, x in zip(s, g) if not x)))
                  for r, s, g in zip(rows, seqs, covered(seqs, length)))
    docs = edge_docs.where("doc_id <> 4 OR doc_id IS NULL")
    got = suffixes.dedup_bytes(docs, length=length, crowd=crowd).collect()
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept))) for r in got) == want


def test_near_copies_with_many_contexts(spark):
    rng = np.random.default_rng(1)
    passage = bytes(rng.integers(97, 123, 330).astype(np.uint8)).decode()
    texts = []
    for i in range(120):
        own = bytes(rng.integers(97, 123, 150).astype(np.uint8)).decode()
        cut = int(rng.integers(0, 100))
        texts.append((i, own[:cut] + passage[cut // 2: 330 - cut // 3] + own[cut:]))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    seqs = [t.encode() for _, t in texts]
    want = [int(g.sum()) for g in covered(seqs, 200)]
    for crowd in (1000, 64, 3):
        got = {r.doc_id: r.n_removed for r in suffixes.dedup_bytes(docs, crowd=crowd).collect()}
        assert [got[i] for i in range(120)] == want


def test_one_letter_and_long_texts(spark, edge_docs, no_docs):
    got = {r.doc_id: r for r in suffixes.dedup_bytes(edge_docs).where("doc_id IN (4, 15)").collect()}
    assert got[15].n_removed == 700  # 200 equal letters start in 501 places
    assert got[4].n_bytes > 100_000
    assert suffixes.dedup_bytes(no_docs).count() == 0 and substrings.dedup_substrings(no_docs).count() == 0


def test_kept_rows_have_all_columns(edge_docs, edge_rows, no_docs):
    kept = suffixes.keep_new_bytes(edge_docs, length=60)
    assert kept.columns == edge_docs.columns
    rows = kept.collect()
    assert len(rows) == len(edge_rows) and all(r.n_chars == len(r.text) for r in rows)
    assert suffixes.keep_new_bytes(no_docs).count() == 0


def test_loser_tree_merges_front_coded_runs():
    rng = np.random.default_rng(2)
    runs_, all_ = [], []
    for _ in range(7):
        texts = sorted(bytes(rng.integers(97, 99, int(rng.integers(1, 12))).astype(np.uint8)) for _ in range(int(rng.integers(0, 30))))
        all_ += texts
        if texts:
            run = [suffixes.Suffix(1, 2, 1, t, b"", 1) for t in texts]
            runs_.append(suffixes.decoded(*suffixes.front_coded(run), 1))
    got = list(suffixes.merged(runs_))
    assert [s.forward for _, s in got] == sorted(all_)
    for (_, a), (lcp, b) in zip(got, got[1:]):
        assert lcp == suffixes.common(a.forward, b.forward)


def test_query_digest_of_kept_bytes(spark):
    r = QUERIES["op6_suffix_merge_sort"](spark, SF).where("n_removed = n_bytes").first()
    assert r is None or r.kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_words_that_a_polynomial_hash_takes_as_equal(spark):
    """Two windows that differ in one long word (Thue-Morse order of two letters, and its complement) are not equal."""
    one = "".join("ab"[i.bit_count() & 1] for i in range(4096))
    other = one.translate({97: 98, 98: 97})
    rest = " ".join(f"w{i}" for i in range(34))
    df = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"x {one} {rest}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substrings.dedup_substrings(df).collect()} == {1: 35, 2: 0, 3: 35}


def test_many_equal_rows(spark):
    """Rows equal in id and text share their findings: the work grows with their number, not its square."""
    text = " ".join(f"word{i}" for i in range(300))
    df = spark.createDataFrame([(1, text)] * 3000 + [(2, text + " tail"), (3, "alone " * 3)], "doc_id long, text string").repartition(8)
    got = Counter((r.doc_id, r.n_removed) for r in substrings.dedup_substrings(df).collect())
    assert got == {(1, 300): 3000, (2, 300): 1, (3, 0): 1}
    got = Counter((r.doc_id, r.n_removed) for r in suffixes.dedup_bytes(df).collect())
    assert got == {(1, len(text)): 3000, (2, len(text)): 1, (3, 0): 1}
