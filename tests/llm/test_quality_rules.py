import re
from collections import Counter

import pytest

from stellate.llm import quality_rules as rules
from stellate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(lines), len(covered))


def brute(rows, least):
    """(lang, source, text) rows -> (counts, base_failed, kept)."""
    found = []
    for lang, source, text in rows:
        c = dict(zip(COUNTS, brute_counts(text)))
        n = c["n_words"]
        r = {"word_length": 10**6 * c["word_chars"] // n, "symbol_rate": 10**6 * c["n_symbols"] // n, "dup_line_rate": 10**6 * c["n_dup_lines"] // c["n_lines"],
             "repeat_rate": 10**6 * c["n_repeat_words"] // n} if n else None
        found.append((lang, source, c, r))

    def cut(v):
        size = max(v.bit_length() - rules.BITS, 0)
        return v >> size << size

    def bounds(members, metric):
        values = sorted(cut(r[metric]) for r in members)
        q10, q50, q90 = (values[-(-q * len(values) // 100) - 1] for q in (10, 50, 90))
        t = rules.TOLERANCE[metric]
        low = max(q10 - 3 * max(q50 - q10, t), 0) if metric in rules.TWO_SIDED else 0
        return low, q90 + 3 * max(q90 - q50, t)

    out, known = [], {}
    for lang, source, c, r in found:
        base = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        if r and (lang, source) not in known:
            group = [x[3] for x in found if x[3] and x[:2] == (lang, source)]
            if len(group) < least:
                group = [x[3] for x in found if x[3] and x[0] == lang]
            if len(group) < least:
                group = [x[3] for x in found if x[3]]
            known[lang, source] = {m: bounds(group, m) for m in rules.TOLERANCE}
        inside = r is not None and all(lo <= r[m] <= hi for m, (lo, hi) in known[lang, source].items())
        out.append((tuple(c[k] for k in COUNTS), base, not base and inside))
    return out


def judged(df, least=rules.LEAST):
    return [((tuple(r[k] for k in COUNTS)), r["base_failed"], r["kept"]) for r in rules.apply_rules(df, least=least).collect()]


def test_query_against_brute_force(spark, documents):
    rows = documents.select("doc_id", "lang", "source", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute([r[1:] for r in rows], rules.LEAST)))
    got = QUERIES["op12_adaptive_quality_rules"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        counts, base, kept = want[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == (*counts[:4], counts[5], base, kept)


@pytest.mark.parametrize("least", [1, 20, 60, 10_000])
def test_levels(spark, documents, least):
    """Groups of enough documents by themselves, the others by language or all."""
    rows = documents.select("lang", "source", "text").collect()
    assert Counter(judged(documents, least)) == Counter(brute(rows, least))


def test_edge_rows(spark, edge_docs, edge_rows, no_docs):
    for least in (1, 200):
        assert Counter(judged(edge_docs, least)) == Counter(brute([(r[2], r[3], r[1]) for r in edge_rows], least))
    assert rules.apply_rules(no_docs).count() == 0


def test_lines_words_and_windows_stay_in_their_text(spark):
    texts = ["a b c d e", "a b c d e", "x\nx\n\n \nx", "x", "x\ny", "a b c d e a b c d e", "a a a a a a", "no\r\nno\r\nno", "é<é>ü  |\t#", "\n", "x\n"]
    df = spark.createDataFrame([(i, "en", "s", t, None) for i, t in enumerate(texts)], "doc_id long, lang string, source string, text string, x int").coalesce(1)
    got = {r.doc_id: tuple(r[k] for k in COUNTS) for r in rules.measure(df).collect()}
    assert [got[i] for i in range(len(texts))] == [brute_counts(t) for t in texts]


def test_sketches_merge(spark, documents):
    """Base and increment merged, in any order, are the sketch of the whole, and quantiles keep their error."""
    measured = rules.measure(documents)
    odd = measured.where("doc_id % 3 = 0")
    whole = {tuple(r) for r in rules.sketch(measured).collect()}
    a, b = rules.sketch(odd), rules.sketch(measured.where("doc_id % 3 <> 0"))
    assert {tuple(r) for r in rules.merge(a, b).collect()} == whole == {tuple(r) for r in rules.merge(b, a).collect()}
    values = sorted(r.v for r in measured.where("n_words > 0").select(rules.ratios()["word_length"].alias("v")).collect())
    q = rules._quantiles(rules.sketch(measured), []).where("metric = 'word_length'").first()
    for share in (10, 50, 90):
        exact = values[-(-share * len(values) // 100) - 1]
        assert exact * (1 - 2 ** (1 - rules.BITS)) < q[f"q{share}"] <= exact


def test_outliers_of_a_group_go_and_others_stay(spark):
    """Symbols are usual in one source and an outlier in another."""
    rows = [(i, "en", "code", f"value{i} = <x> & <y> ; call me now please thanks you all") for i in range(300)]
    rows += [(1000 + i, "en", "news", f"story {i} with plain words that say what was seen today") for i in range(300)]
    rows += [(5000, "en", "news", "story # # # * * * $ $ with plain words % % &"), (5001, None, None, "a source of its own with ten plain words in it")]
    kept = {r.doc_id: r.kept for r in rules.apply_rules(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).collect()}
    assert not kept.pop(5000) and all(kept.values())
