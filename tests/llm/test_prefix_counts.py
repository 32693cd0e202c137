import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stellate.llm import prefix_counts as C
from stellate.llm import vocab
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["it's we'll '!'ll don''t 12a3 x", "ünï ßçé ... !!'s", "internationalization of things's", " a\n\n b \t",
       "<|endoftext|> hi <|startoftext|>", "日本語 é İstanbul ΣΑΣ", "😀😀 a", "a  b   c \n d\n\n  e", "x\t \ny z", " lead", "trail ",
       " \n", "a\u00a0b", "\u212a \u212b ẞ Ÿ", "<|x <|endoftext|>y", "\x1c a \x85 b", "a 's 'll's", "\r\n \r\n x", "q" * 300, "", "e\u0301 x"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def n_tokens(tok, text):
    return len(tok.encode(text, add_special_tokens=False).ids)


def test_query_against_the_library(spark, tok, document_rows):
    got = {r.doc_id: r for r in QUERIES["op10_prefix_token_counts"](spark, SF).collect()}
    for doc, text in document_rows:
        r = got[doc]
        assert (r.n_tokens, r.n_bytes) == (n_tokens(tok, text), len(text.encode())) and r.over_limit == (r.n_tokens > 2048)


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_has_its_exact_count(tok, text):
    counts = C.counts_of(C.prefix_table(PATH, text))
    assert counts[-1] == n_tokens(tok, text)
    try:
        C.piece_tables(PATH).table(text)
    except vocab.Unusual:
        return  # the library's own cuts: only whole pieces are exact
    assert counts.tolist() == [n_tokens(tok, text[:k]) for k in range(len(text) + 1)]


@pytest.mark.parametrize("text", [*ODD, "hello世界", "say “it’s” — 5€ a\u00a0b", "'re\u0301 we'll\u0308 A\u0323\u0302x", "각 각 क़",
                                  "x<|endoftext|>'s <|endoftext <|startoftext<|startoftext|>|>é", "İIıſ ΣΑΣ. Ὀδυσσεύς", "😀👍🏽 a😀b"])
def test_every_prefix_of_any_text_has_its_exact_count(tok, text):
    counts = C.counts_of(C.prefix_table(PATH, text))
    assert counts.tolist() == [n_tokens(tok, text[:k]) for k in range(len(text) + 1)]


def test_every_prefix_of_random_texts(tok):
    rng = np.random.default_rng(3)
    letters = list("aeRsl' 3!-") + list("’—€世界ñΣİक़é각ᄀ\u1161\u11a8\u0301\u0323\u0344\u00a0\x85\x1c\u212b😀\u200d") + ["<|endoftext|>", "<|", "'ll"]
    for _ in range(300):
        text = "".join(rng.choice(letters, 12))
        counts = C.counts_of(C.prefix_table(PATH, text))
        assert counts.tolist() == [n_tokens(tok, text[:k]) for k in range(len(text) + 1)], text


@pytest.mark.parametrize("marks", ["\u0301" * 90, "\u0323\u0301" * 60, "\u0301" * 70 + "\u0323" * 5 + "\u0344" * 9])
def test_every_prefix_of_long_groups_of_marks(tok, marks):
    text = "ye" + marks + " we'll a" + marks[:80]
    counts = C.counts_of(C.prefix_table(PATH, text))
    assert counts.tolist() == [n_tokens(tok, text[:k]) for k in range(len(text) + 1)]


def test_a_group_of_thousands_of_marks_ends(tok):
    text = "e" + "\u0301" * 4000
    assert C.counts_of(C.prefix_table(PATH, text))[-1] == n_tokens(tok, text)


def test_wide_steps_round_trip():
    for steps in ([], [1, 0, -127], [128, 1, -128, 127, 0, 70000, 128], [0, -300]):
        table = C.packed(steps)
        assert C.steps_of(table).tolist() == steps and C.counts_of(table).tolist() == [0, *np.cumsum(steps).tolist()]


def test_cuts_of_odd_texts_stay_within_the_budget(spark, tok):
    docs = spark.createDataFrame([(0, "hello世界"), (1, "it’s 5€")], "doc_id long, text string")
    text = {r.doc_id: r.text for r in docs.collect()}
    for budget in range(4):
        for r in C.budget_cuts(C.token_counts(docs, PATH), budget).collect():
            assert n_tokens(tok, text[r.doc_id][:r.n_chars_kept]) == r.n_tokens_kept <= budget


def test_prefixes_of_documents(tok, document_rows):
    for _, text in document_rows[::17]:
        counts = C.counts_of(C.prefix_table(PATH, text))
        for k in range(0, len(text), 29):
            assert counts[k] == n_tokens(tok, text[:k])


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(text):
    lib = Tokenizer.from_file(BYTE)
    assert vocab.piece_ids(BYTE).ids(text) == vocab.encoded(lib, text)


def test_edges_and_budgets(tok, edge_docs, edge_rows, no_docs):
    counted = C.token_counts(edge_docs, PATH)
    rows = counted.collect()
    assert len(rows) == len(edge_rows)
    text = {r[0]: r[1] or "" for r in edge_rows}
    for r in rows:
        assert r.n_tokens == n_tokens(tok, text[r.doc_id]) and r.n_bytes == len(text[r.doc_id].encode())
        assert len(r.prefix_table) == len(text[r.doc_id])
    for budget in (0, 7, 1000):
        for r in C.budget_cuts(counted, budget).collect():
            kept = text[r.doc_id][:r.n_chars_kept]
            assert n_tokens(tok, kept) == r.n_tokens_kept <= budget
    assert C.token_counts(no_docs, PATH).count() == 0
    assert C.token_counts(edge_docs, PATH, tables=False).columns == ["doc_id", "n_bytes", "n_tokens"]
