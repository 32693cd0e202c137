import bisect
import hashlib
import json
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stellate.llm import alignment
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def library():
    """Whole texts by the two libraries -> [(id, bytes)] by A and by B."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    names = {i: t for t, i in json.load(open(A))["model"]["vocab"].items()}
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = [x for x in range(256) if x not in kept]
    letter = {chr(x): x for x in kept} | {chr(256 + i): x for i, x in enumerate(spare)}

    def both(text):
        left = [(i, bytes(letter[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
                 for i in b.encode(text)]
        return left, right
    return both


def offsets(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((i, at, at := at + len(x)))
    return out


def brute(texts, both):
    docs = []
    for text in texts:
        left, right = both(text) if text else ([], [])
        whole = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
            docs.append(None)
            continue
        left, right = offsets(left), offsets(right)
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        inside = [[[] for _ in cuts] for _ in range(2)]
        for side, tokens in zip(inside, (left, right)):
            for i, _, e in tokens:
                side[bisect.bisect_left(cuts, e)].append(str(i))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*inside)]
        ends = {}
        for i, _, e in right:
            ends.setdefault(e, []).append(i)
        docs.append((len(left), len(right), groups, [(i, j) for i, _, e in left for j in ends.get(e, ())]))
    counts = Counter(x for d in docs if d for x in d[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(counts[x] == best[x[1]] for x in d[3]), sum(counts[x] for x in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs], counts


HARD = ["", None, " ", "a ", "a  b", "  lead", "tab\there", "x\r\n y", "a  b", "a　 b", "a   b ", "▁x y", "a\x00b c", "<s>hi</s> <|endoftext|> end",
        "日本語 テキスト", "👩‍👩‍👧 ok", "é́ e", "A" * 3000, "word " * 500, "don't we'll", "\x01 \x02", "-- ==> {\r", "x​ y", "1 234 5678"]


def test_query_against_the_libraries(spark, document_rows, library):
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_cross_tokenizer_alignment"](spark, SF).collect()}
    want, _ = brute([t for _, t in document_rows], library)
    assert len(got) == len(document_rows)
    for (doc, _), row in zip(document_rows, want):
        assert got[doc] == row


def test_hard_texts_and_pairs(spark, library):
    texts = HARD + HARD[3:9] + ["a " * 40, "a " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS slice", "2 AS pair", "'x' AS ids").repartition(3)
    docs, pairs = alignment.align(df, A, B)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in docs.collect()}
    want, counts = brute(texts, library)
    assert [got[i] for i in range(len(texts))] == want
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(counts)


def test_edge_rows(spark, edge_docs, edge_rows, no_docs, library):
    docs, _ = alignment.align(edge_docs, A, B)
    want, _ = brute([r[1] for r in edge_rows], library)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted(((r["doc_id"], *[r[c] for c in COLUMNS]) for r in docs.collect()), key=key) == sorted(
        ((r[0], *w) for r, w in zip(edge_rows, want)), key=key)
    assert alignment.align(no_docs, A, B)[0].count() == 0


def test_one_slice_a_text(spark, document_rows, library, monkeypatch):
    """Cutting the corpus into many slices changes nothing."""
    monkeypatch.setattr(alignment, "SLICE_BYTES", 1)
    texts = [t for _, t in document_rows[:40]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.align(df, A, B)[0].collect()}
    assert [got[i] for i in range(40)] == brute(texts, library)[0]


def test_short_rows(spark, document_rows, library, monkeypatch):
    """Cutting slices into many rows changes nothing."""
    monkeypatch.setattr(alignment, "ROW_LINKS", 1)
    monkeypatch.setattr(alignment, "ROW_PAIRS", 2)
    monkeypatch.setattr(alignment, "BLOCK_TOKENS", 1)
    texts = [t for _, t in document_rows[:40]] + HARD
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    docs, pairs = alignment.align(df, A, B)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in docs.collect()}
    want, counts = brute(texts, library)
    assert [got[i] for i in range(len(texts))] == want
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(counts)


def test_staged_rows_are_small(spark, monkeypatch):
    """A slice of 4 MB of many different words is staged as rows of which none holds 256 KB."""
    held, stage = [], alignment.stage
    monkeypatch.setattr(alignment, "stage", lambda df, name: held.append(stage(df, name)) or held[-1])
    texts = [" ".join(f"{(i * 7919 + j * 104729) % 99991:x}é" for j in range(500)) for i in range(1200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    docs, _ = alignment.align(df, A, B)
    rows = [r for r in held[0].collect() if r.vector is None]
    assert sum(len(r.ids) for r in rows) == len(texts) == docs.count()
    size = lambda v: len(v) if isinstance(v, (bytes, bytearray, str)) else sum(map(size, v)) if isinstance(v, list) else 8
    assert max(sum(size(v) for v in r if v is not None) for r in rows) < 1 << 18


def test_packed_numbers():
    import numpy as np
    for values in ([], [0], [1, 255, 256, 65535, 65536, 2**32 - 1, 7]):
        assert alignment.unpacked(alignment.packed(np.array(values, np.int64))).tolist() == values


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r.ab1'<|é日  　́"), st.characters(codec="utf-8")), min_size=1, max_size=40))
def test_parts_give_the_ids_of_whole_texts(library, text):
    """Cutting at spaces keeps every id of both libraries."""
    import numpy as np
    table = alignment.aligner(A, B)
    raw = text.encode()
    found = table.slice(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    codes = found.codes
    left, right = library(text)
    if b"".join(x for _, x in right) != b" " + raw:
        assert len(codes) == 0
    else:
        groups = b"".join([found.groups[c] for c in codes]).decode()[:-1].split(";")
        assert [int(i) for g in groups for i in g.split("|")[0].split(",")] == [i for i, _ in left]
        assert [int(i) for g in groups for i in g.split("|")[1].split(",")] == [i for i, _ in right]
