import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from stellate.llm import packing
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts):
    tok = Tokenizer.from_file(PATH)
    return [np.array([*e.ids, 1], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(pieces, ids):
    """Each id in one piece, pieces in order, lengths powers of two."""
    at = 0
    for p in sorted(pieces, key=lambda p: p.start):
        assert p.start == at and p.offset == 0 and p.doc_tokens == len(ids)
        assert p.length & (p.length - 1) == 0 and p.length <= 2048
        assert bytes(p.ids) == ids[at:at + p.length].tobytes()
        at += p.length
    assert at == len(ids)


def test_query_against_the_library(spark, document_rows):
    got = {}
    for r in QUERIES["op3_power_of_two_packing"](spark, SF).collect():
        got.setdefault(r.doc_id, []).append(r)
    for (doc, _), ids in zip(document_rows, library_ids([t for _, t in document_rows])):
        at = 0
        for p in sorted(got[doc], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes()) and p.doc_tokens == len(ids)
            at += p.length
        assert at == len(ids)
    every = [p.sequence_id for v in got.values() for p in v]
    assert len(every) == len(set(every))


def test_edges(edge_docs, edge_rows, no_docs):
    got = packing.pack(edge_docs, PATH).collect()
    ids = {r[0]: i for r, i in zip(edge_rows, library_ids([r[1] for r in edge_rows]))}
    for doc in ids:
        mine = [p for p in got if p.doc_id == doc]
        if doc == 13:  # a repeated row has pieces of its own
            mine = sorted(mine, key=lambda p: p.sequence_id)
            assert len(mine) % 2 == 0
            mine = mine[:len(mine) // 2]
        check_pieces(mine, ids[doc])
    assert [p.length for p in got if p.doc_id == 2] == [1]
    assert packing.pack(no_docs, PATH).count() == 0


def test_cuts_are_the_binary_digits():
    for n in (1, 2, 3, 2047, 2048, 2049, 5000, 6144):
        pieces = packing.cuts(n)
        assert sum(length for _, length in pieces) == n
        assert [s for s, _ in pieces] == [sum(length for _, length in pieces[:i]) for i in range(len(pieces))]
        rest = [length for _, length in pieces if length < 2048]
        assert len(rest) == bin(n % 2048).count("1")


def test_buckets_round_trip(spark, documents, tmp_path):
    pieces = packing.pack(documents.limit(20), PATH)
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == pieces.count() and back.where("length(ids) <> 4 * length").count() == 0


def test_hard_texts(spark):
    """Parts cut at spaces keep the library's ids: white space of all kinds, other scripts, special strings."""
    texts = ["a ", " a", "a  b", "a b  c ", "x　 y", "<|endoftext|> a <|endoftext|>", "a<|endoftext|> b", "日本 語 テ", "é́ e x", "\n a\n b", " ", "don't 've  's",
             "x\x85 y", "x  y", "tab\t \tx", "a\x7f b", "\x01 \x02"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    got = {}
    for p in packing.pack(df, PATH).collect():
        got.setdefault(p.doc_id, []).append(p)
    for i, ids in enumerate(library_ids(texts)):
        check_pieces(got[i], ids)
