import math
import re
from collections import Counter

import pytest

from stellate.llm import lexical
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
_UPPER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(_UPPER))


def brute(docs, items, top=10):
    """(id, text) rows -> {(item, rank): (id, score)} of the contract's formula."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(x for _, c, _ in held for x in c)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for d, c, n in held:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 8 * m)) for x in set(terms(text)) if c[x])
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def rows(df, item="item_id", doc="doc_id"):
    return sorted(((r[item], r["rank"], r[doc], r["score"]) for r in df.collect()), key=str)


def test_query_against_brute_force(spark, document_rows):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(QUERIES["op11_stratified_search"](spark, SF)) == brute(document_rows, items)


@pytest.mark.parametrize("block_docs,visits,item_bytes,cells", [(1, 1, 300, 1 << 21), (3, 2, 1 << 22, 64), (4096, 1, 1 << 22, 1)])
def test_small_blocks(spark, document_rows, monkeypatch, block_docs, visits, item_bytes, cells):
    """Blocks of a document, a few visits, many item blocks and small score tables change nothing."""
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs = document_rows[:60] + document_rows[:20] + [(1000 + d, t) for d, t in document_rows[:60]]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").limit(8).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = lexical.search(df, spark.createDataFrame(items, "item_id long, text string"), item_bytes=item_bytes, block_docs=block_docs, visits=visits)
    assert rows(found) == brute(docs, items)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    items = [(1, "alphabeta ONE two 日本語 straße"), (2, None), (3, ""), (4, "..."), (None, "one a123 123"), (1, "alphabeta ONE two 日本語 straße"),
             (1, "another text two"), (6, " ".join(edge_rows[0][1].split()[:40]))]
    asked = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, name string, m long")
    docs = [(r[0], r[1]) for r in edge_rows]
    assert rows(lexical.search(edge_docs, asked)) == brute(docs, items)
    assert lexical.search(no_docs, asked).count() == 0 == lexical.search(edge_docs, asked.where("false")).count()


def test_text_ids_ties_and_top(spark):
    docs = [(f"d{i:02d}", "same words here") for i in range(30)] + [("z", "other"), ("a", "same same words")]
    df = spark.createDataFrame(docs, "key string, body string").repartition(5)
    asked = spark.createDataFrame([("q", "words same")], "item string, ask string")
    got = rows(lexical.search(df, asked, 4, "key", "body", "item", "ask"), "item", "key")
    assert [r[2] for r in got] == ["a", "d00", "d01", "d02"] and got[1][3] == got[3][3] < got[0][3]


def test_bound_is_never_under_a_score(spark, documents):
    """A block's bound covers each of its documents, so a skipped block has no better one."""
    import numpy as np
    items = lexical.Items([bytes(r.text.encode()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(12).collect()])
    held = lexical.document_terms(documents, items, "doc_id", "text")
    n_docs, n_terms = held.selectExpr("count(*)", "sum(n)").first()
    items.weights[:] = 7
    for r in lexical.build_index(held, n_docs, n_terms, 5).collect():
        columns = [np.frombuffer(r[c], "<i4").astype(np.int64) for c in lexical._RUNS]
        bound = lexical.bounds(items, columns[0], np.frombuffer(r["tops"], "<i4").astype(np.int64), r["m"])
        item, _, score = lexical.score_block(items, r["m"], columns, len(r["docs"]), np.arange(items.n), np.zeros(items.n, np.int64), 5)
        assert len(r["docs"]) <= 5 and (score <= bound[item]).all()
