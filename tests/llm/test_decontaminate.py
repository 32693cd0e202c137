import re
from collections import defaultdict

import numpy as np

from stellate.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    phrases = defaultdict(set)
    for name, text in items:
        w = split(text)
        for i in range(max(len(w) - 13, 0) + 1 if w else 0):
            phrases[tuple(w[i:i + 13])].add("" if name is None else str(name))
    sizes = {len(p) for p in phrases}
    out = []
    for text in docs:
        w, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i:i + n])) in phrases:
                    found |= phrases[p]
                    hit |= set(range(i, i + n))
        out.append((len(w), len(hit), sorted(found)))
    return out


def test_edges_against_brute_force(spark, edge_docs, edge_rows, no_docs):
    long_words = split(edge_rows[4][1])
    items = [(1, " ".join(long_words[500:560])), (2, "one TWO"), (3, None), (4, "..."), (None, "ñandú — 日本語"), (2, "one TWO"),
             (5, " ".join(split(edge_rows[7][1])[:20]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(map(str, brute([r[1] for r in edge_rows], items)))
    for block in (1 << 25, 60):
        got = D.decontaminate(edge_docs, bench, block_bytes=block).collect()
        assert sorted(str((r.n_words, r.n_hit, list(r["items"]))) for r in got) == want
        for r in got:
            assert r.n_hit == sum(s.end_word - s.first_word for s in r.spans)
            assert r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
    text = {r[0]: r[1] for r in edge_rows}
    s = next(r for r in got if r.doc_id == 14).spans[0]
    assert text[14].encode()[s.first_byte:s.end_byte] == b"one two"
    assert D.decontaminate(no_docs, bench).count() == 0
    empty = bench.limit(0)
    assert D.decontaminate(edge_docs, empty).where("n_hit > 0 OR contaminated").count() == 0
    kept = D.keep_clean(edge_docs, bench)
    assert kept.columns == edge_docs.columns and 14 not in [r.doc_id for r in kept.collect()]


def test_a_block_may_begin_with_an_item_without_words(spark, edge_docs, edge_rows):
    items = [(4, "..."), (2, "one TWO"), (5, " ".join(split(edge_rows[7][1])[:20])), (6, " ")]
    bench = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    got = D.decontaminate(edge_docs, bench).collect()
    want = sorted(map(str, brute([r[1] for r in edge_rows], items)))
    assert sorted(str((r.n_words, r.n_hit, list(r["items"]))) for r in got) == want
    assert D.Phrases([("a", b"..."), ("b", b"x y z")]).size.tolist() == [3]


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(5)
    symbols = np.concatenate([rng.integers(1, 4, 400), [0], rng.integers(1, 4, 300), [0]])
    index = D.FmIndex(symbols, 3)
    text = symbols.tolist()
    for n in (1, 2, 5):
        for i in range(0, 390, 7):
            p = text[i:i + n]
            lo, hi = index.search(np.array(p[::-1])[:, None], np.array([n]))
            where = [j for j in range(len(text) - n + 1) if text[j:j + n] == p]
            assert sorted(index.locate(np.arange(lo[0], hi[0])).tolist()) == where


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(6)
    s = np.append(rng.integers(1, 3, 200), 0)
    want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
    assert D.suffix_array(s).tolist() == want


def thue_morse(n):
    """A word of the letters a, b in the Thue-Morse order, and its complement."""
    word = "".join("ab"[i.bit_count() & 1] for i in range(n))
    return word, word.translate({97: 98, 98: 97})


def test_words_that_a_polynomial_hash_takes_as_equal(spark):
    one, other = thue_morse(4096)
    rest = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{other} {rest}")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, f"{one} {rest}")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in D.decontaminate(docs, bench).collect()}
    assert got == {1: (13, True), 2: (0, False)}


def test_rows_keep_their_columns_over_many_blocks(spark, edge_docs, edge_rows):
    items = [(i, " ".join(split(edge_rows[k][1])[:30])) for i, k in enumerate((0, 4, 7))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.keep_clean(edge_docs, bench)
    assert kept.columns == edge_docs.columns
    dirty = {str(r.doc_id) for r in D.decontaminate(edge_docs, bench, block_bytes=100).where("contaminated").collect()}
    assert dirty and {str(r.doc_id) for r in kept.collect()} == {str(r[0]) for r in edge_rows} - dirty
