import pytest

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    """Reproducible text of n words."""
    x, out = seed * 7919 + 1, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x >> 16 & 15] + WORDS[x >> 20 & 7])
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, copies and near copies."""
    long_text = prose(5, 20_000)
    shared = prose(9, 60)
    return [
        (1, prose(1, 120), "en", "a", 1), (2, None, "en", None, None), (3, "", None, "a", 0), (None, prose(2, 50), "en", "b", 3),
        (4, long_text, "en", "a", 5), (5, prose(1, 120), None, "c", 1), (6, prose(1, 119) + " changed", "de", "a", 2),
        (7, shared + " " + prose(11, 40), "en", "a", 2), (8, prose(12, 30) + "\n" + shared, "en", "a", 2),
        (9, "Ünïcode ßtraße ñandú — 日本語 x", "de", "d", 9), (10, "  \t\n ", "en", "a", 4), (11, "!!! 123 ???", "en", "a", 11),
        (12, shared + " " + shared, "en", "a", 2), (13, prose(20, 80), "en", "a", 1), (13, prose(20, 80), "en", "a", 1),
        (14, "one two", "en", "z", 7), (15, "a" * 700, "en", "z", 700),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows with columns whose names the operators use inside."""
    df = spark.createDataFrame(edge_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "source AS id", "n_chars AS row", "lang AS ranges", "1 AS h", "2 AS c", "3 AS k", "'x' AS fp")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def document_rows(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
