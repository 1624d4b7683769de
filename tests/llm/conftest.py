import string

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use inside.
CLASHING = ("row_id id norm hash tag recipe chunks chunk fp kind text_sha256 _text _hash _id _tag _spans entities "
            "n_entities spans base found h c pos epoch block slot tokens weight score lang_pred ids n_tokens decoded "
            "path licence kept n_links node").split()
LONG = " ".join(f"word{i % 977} {string.ascii_lowercase[i % 26] * 3}" for i in range(30_000))
EDGES = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "", None, None, None), (None, "one text", "en", "a", 8),
    (None, None, None, None, None), (4, "One Text", "en", "b", 8), (4, "One Text", "en", "b", 8),
    (5, "one text", "de", None, 8), (6, LONG, "en", "a", len(LONG)), (7, LONG, "en", "b", len(LONG)),
    (8, "!!! 123 ---", "en", "a", 11), (9, "\n \t  ", "fr", "a", 5), (10, "é" * 50_000, "fr", "b", 50_000),
    (11, "漢字かな " * 40, "ja", "c", 200), (4, "other text under the same id", "en", "a", 28), (12, "a b", "en", "a", 3),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """Edge rows with more columns, named as the operators might name theirs."""
    rows = [(*row, *(f"{name} of {n}" for name in CLASHING)) for n, row in enumerate(EDGES)]
    return spark.createDataFrame(rows, SCHEMA + "".join(f", `{name}` string" for name in CLASHING))


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
