import re

import numpy as np
import xxhash

from stellate.llm import simhash as S
from stellate.llm.components import components
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    a = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= 2) + i + 1:
            x, y = find(i), find(int(j))
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


def test_query_against_brute_force(spark, document_rows):
    rows = sorted(document_rows)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (format(fps[i], "016x"), rows[r][0]) for i, r in enumerate(brute_components(fps))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_gray_index"](spark, SF).collect()}
    assert got == want


def test_edges(edge_docs, edge_rows, no_docs):
    got = S.near_duplicates(edge_docs).collect()
    assert len(got) == len(edge_rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i in (2, 3, 10):  # no words: fingerprint zero, linked like any other
        assert by_id[i][0].fp == 0 and by_id[i][0].component_id == 2
    assert by_id[5][0].component_id == 1 and len(by_id[13]) == 2
    assert by_id[14][0].fp == np.uint64(brute_fingerprint("one two")).view(np.int64)
    assert S.near_duplicates(no_docs).count() == 0


def test_representatives_keep_one_row_of_each_class(edge_docs, no_docs):
    kept = S.keep_representatives(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(13) == 1 and 5 not in ids and 1 in ids and None in ids and [i for i in ids if i in (2, 3, 10)] == [2]
    assert S.keep_representatives(no_docs).count() == 0


def test_large_groups_are_dealt_again(spark):
    rng = np.random.default_rng(3)
    w = np.full(1500, rng.integers(0, 2**63), np.uint64)
    for _ in range(3):
        w ^= np.uint64(1) << rng.integers(0, 24, len(w)).astype(np.uint64)
    w = np.unique(w)
    df = spark.createDataFrame([(int(x),) for x in w.view(np.int64)], "fp long")
    want = len(set(brute_components(w)))
    for large in (4096, 16):
        found = components(S.links(df, 2, large))
        joined = {r.node: r.root for r in found.collect()}
        assert len({joined.get(int(x), int(x)) for x in w.view(np.int64)}) == want


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    df = spark.createDataFrame(path + star + [(5, 5), (7, 6)], "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(200))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
