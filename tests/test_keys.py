import datetime as dt
import random
from itertools import combinations

import numpy as np
import pytest

from stellate.operators import keys as K


def brute(rows, columns, max_size=4):
    found = []
    for n in range(1, max_size + 1):
        for c in combinations(range(len(columns)), n):
            values = [tuple(r[i] for i in c) for r in rows]
            if rows and len(set(values)) == len(rows) and all(v is not None for x in values for v in x) and not any(set(k) <= set(c) for k in found):
                found.append(c)
    return [tuple(columns[i] for i in k) for k in found]


def table(seed, n, sizes, nulls=()):
    r = random.Random(seed)
    rows = [tuple(None if i in nulls and r.random() < .05 else r.randrange(s) for i, s in enumerate(sizes)) for _ in range(n)]
    return list(dict.fromkeys(rows))


SHAPES = {"pairs": (1, 300, (20, 20, 20, 3, 2)), "four": (2, 120, (4, 4, 4, 4, 4)), "nulls": (3, 200, (60, 15, 15, 15, 4), (1,)),
          "single": (4, 150, (10**9, 12, 12, 10**9)), "none": (5, 400, (5, 4, 3, 3, 3, 2))}


@pytest.mark.parametrize("sample", [2, 1000])
def test_against_brute_force(spark, sample):
    """All tables in one search, at most one scan a level; what a sample can tell changes nothing but the work."""
    rows = {t: table(*s) for t, s in SHAPES.items()}
    cols = {t: [f"c{i}" for i in range(len(SHAPES[t][2]))] for t in SHAPES}
    tables = {t: spark.createDataFrame(rows[t], ", ".join(f"{c} long" for c in cols[t])) for t in SHAPES}
    found, scans = K.unique_combinations(tables, sample_rows=sample)
    assert scans <= 4
    assert {t: sorted(v) for t, v in found.items()} == {t: sorted(brute(rows[t], cols[t])) for t in SHAPES}


def test_types_repeats_and_empty_tables(spark):
    day = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, "x", day, 1.5), (1, "y", day, 2.5), (2, "x", day, 3.5)], "a int, b string, c timestamp, d double")
    tables = {"a": a, "twice": a.unionAll(a), "empty": a.limit(0), "one": a.limit(1), "floats": a.select("d")}
    found, _ = K.unique_combinations(tables)
    assert found["a"] == [("a", "b")]  # floating numbers carry no key
    assert found["twice"] == [] and found["empty"] == [] and found["one"] == [("a",), ("b",), ("c",)] and "floats" not in found
    assert {(r.table_name, tuple(r["columns"])) for r in K.minimal_keys({"a": a}).collect()} == {("a", ("a", "b"))}
    assert K.unique_combinations({"f": a.select("d")}) == ({}, 0)


def test_agree_sets():
    rows = np.array([[1, 2, 3], [1, 2, 9], [7, 2, 3]])
    assert K.agree_sets(rows) == {frozenset({0, 1}), frozenset({1, 2}), frozenset({1})}


def test_sample_leaves_few_candidates(spark):
    """Agree sets and value counts leave a wide table few combinations to count."""
    cols = [f"c{i}" for i in range(12)]
    rows = [(i // 4, i % 4, *[(i * (7 + k)) % (3 + k) for k in range(10)]) for i in range(2000)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in cols))
    search = K._Search(cols)
    search.rows, search.distinct = 2000, {i: len({r[i] for r in rows}) for i in range(12)}
    search.learn(K.agree_sets(np.array(rows[:1000])))
    assert len(search.candidates(3)) < 60 < len(list(combinations(cols, 3)))
    found, _ = K.unique_combinations({"t": df})
    assert sorted(found["t"]) == sorted(brute(rows, cols))


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (2, 1, 6)], "order_id long, line_number long, price long")
    assert [tuple(r) for r in K.composite_key(df, "lines").collect()] == [("lines", "order_id, line_number")]
    assert K.composite_key(df.select("order_id", "price"), "lines").count() == 0


@pytest.mark.parametrize("sample", [2, 1000])
def test_screened_tables(spark, sample):
    """Screening large tables changes nothing but the work."""
    rows = {t: table(*s) for t, s in SHAPES.items()}
    cols = {t: [f"c{i}" for i in range(len(SHAPES[t][2]))] for t in SHAPES}
    tables = {t: spark.createDataFrame(rows[t], ", ".join(f"{c} long" for c in cols[t])) for t in SHAPES}
    found, _ = K.unique_combinations(tables, sample_rows=sample, screen_rows=0)
    assert {t: sorted(v) for t, v in found.items()} == {t: sorted(brute(rows[t], cols[t])) for t in SHAPES}


def test_a_screen_hands_on_little(spark, monkeypatch):
    """Of a table whose values mostly repeat, only keys and their like are counted on all rows, by a digest a row."""
    df = spark.range(20_000).selectExpr("id", "id div 2 as pair", "id % 2 as side", "id % 5000 as many", "cast(id % 3000 as string) as text")
    counted = []
    old = K._counted

    def noted(tables, searches, wanted, *wide):
        counted.extend((searches[t].columns[j] for j in c) for t, c in wanted)
        assert K._digests(tables, searches, wanted).columns == ["id", "h1"]
        return old(tables, searches, wanted, *wide)

    monkeypatch.setattr(K, "_counted", noted)
    found, _ = K.unique_combinations({"t": df}, sample_rows=10, screen_rows=1000)
    assert [tuple(c) for c in counted] == found["t"] == [("id",), ("pair", "side"), ("pair", "many"), ("pair", "text")]


def test_equal_digests_of_different_values(spark, monkeypatch):
    """A narrow digest under which different values meet sends a candidate to the wide one; true repeats stay repeats."""
    df = spark.createDataFrame([(i, i // 2, i % 2, i % 7) for i in range(400)], "a long, b long, c long, d long")
    old = K._digests

    def narrow(tables, searches, wanted, wide=False):
        rows = old(tables, searches, wanted, wide)
        return rows if wide else rows.selectExpr("id", "CASE WHEN abs(h1) % 2 = 0 THEN 0 ELSE h1 END AS h1")

    monkeypatch.setattr(K, "_values", lambda tables, searches: [setattr(s, k, v) for s in searches.values() for k, v in
                                                                (("rows", 400), ("distinct", dict.fromkeys(range(4), 400)))])
    monkeypatch.setattr(K, "_digests", narrow)
    found, _ = K.unique_combinations({"t": df}, sample_rows=2)
    assert found["t"] == [("a",), ("b", "c"), ("b", "d")]


def test_counted_digests_are_packed(spark, monkeypatch):
    """A row and candidate crosses the network in a few bytes, and what is met twice is found whatever the task and group."""
    monkeypatch.setattr(K, "_PACKED", 1 << 14)
    df = spark.range(0, 200_000, 1, 4).selectExpr("id", "id % 199990 as most")
    searches = {"t": K._Search(["id", "most"], rows=200_000)}
    digests = K._digests({"t": df}, searches, [("t", (0,)), ("t", (1,))])
    sent = K._packed(digests, 32, 4).selectExpr("count(*) AS blocks", "sum(n) AS n", "sum(length(packed)) AS bytes").first()
    assert sent.n == 400_000 and sent.blocks < 4000 and sent.bytes < 4.5 * sent.n
    met = {r.h1 for r in digests.where("id = 1").groupBy("h1").count().where("count > 1").collect()}
    found = K._suspects(digests, 60, 4).collect()
    assert len(met) == 10 and {(r.id, r.short) for r in found} == {(1, (h % 2**64) >> 4) for h in met}
    assert set(K._counted({"t": df}, searches, [("t", (0,)), ("t", (1,))])) == {1}


@pytest.mark.parametrize("spare", [0, 14])
def test_more_suspects_than_are_looked_up(spark, monkeypatch, spare):
    """Short digests that meet by chance, and more of them than are looked up, change nothing but the work."""
    monkeypatch.setattr(K, "SPARE", spare)
    monkeypatch.setattr(K, "_SUSPECTS", 1)
    df = spark.range(3000).selectExpr("id", "id div 2 as pair", "id % 2 as side", "cast(id * 7 as string) as text")
    found, _ = K.unique_combinations({"t": df}, sample_rows=2)
    assert found["t"] == [("id",), ("text",), ("pair", "side")]


def test_value_sets_of_many_columns(spark):
    """One shuffle of the values; columns are told apart beyond the bits of one mask."""
    from stellate.operators import discovery as D
    df = spark.range(50).selectExpr(*[f"cast(id + {i // 2 * 100} as long) as c{i}" for i in range(130)])
    sets, listed = D.value_sets({"t": df}, [("t", f"c{i}") for i in range(130)])
    got = {frozenset(listed[c][1] for c in r.cols): r.n for r in sets.collect()}
    assert got == {frozenset({f"c{i}", f"c{i + 1}"}): 50 for i in range(0, 130, 2)}
    assert all(r.cols == sorted(r.cols) for r in sets.collect())
