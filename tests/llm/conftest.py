import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n, vocabulary=400):
    """`n` invented words in short sentences."""
    r, out = random.Random(seed), []
    for _ in range(n):
        out.append(f"w{r.randrange(vocabulary):03d}" + ("." if r.random() < 0.15 else "," if r.random() < 0.1 else ""))
    return " ".join(out)


def edge_rows():
    """Nulls in every column, blanks, a very long text, ties and repeated rows."""
    shared = prose(1, 60)
    return [
        (1, prose(2, 80), "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, "b", 0),
        (4, " \n\t ", "de", None, 4),
        (None, prose(3, 40), "de", "b", 7),
        (None, prose(3, 40), "de", "b", 7),
        (5, prose(4, 30) + " " + shared + " " + prose(5, 30), "en", "a", 9),
        (6, prose(6, 20) + " " + shared + " " + prose(7, 20), None, "b", 9),
        (7, prose(8, 50), "en", "a", 3),
        (7, prose(8, 50), "en", "a", 3),
        (8, prose(8, 50), "en", "c", 3),
        (9, prose(9, 60_000, 3000), "en", "a", 5),
        (10, "Ünïcode “text” 😀 ÄÖ x", "de", "c", 5),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edges):
    """Columns with the names that operators give to their results."""
    names = ("fp", "component_id", "size", "target", "copies", "taken", "removed", "hits", "items", "held", "row", "block", "digest", "q_words", "score")
    return edges.selectExpr("*", *[f"'x' as {n}" for n in names])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
