import pytest

WORDS = "the of river stone and light under bridge old new house green tree walks home with small dog near water tower".split()


def sentence(seed: int, n: int) -> str:
    out = []
    for i in range(n):
        seed = (seed * 1103515245 + 12345) % 2**31
        out.append(WORDS[seed // 7 % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


@pytest.fixture(scope="session")
def edge_rows():
    """Ids and texts: nulls, empty and very long ones, ties, repeated rows, copies, non-ASCII."""
    passage = sentence(5, 60)
    rows = [
        (1, sentence(1, 120)),
        (2, sentence(2, 80) + "\n" + passage),
        (3, passage + " " + sentence(3, 40)),
        (4, sentence(1, 120)),
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, "word"),
        (9, sentence(2, 80).replace("river", "lake")),
        (10, "é中文😀 " * 30 + passage),
        (11, ("spam spam " * 40).strip()),
        (12, sentence(12, 30_000)),
        (13, sentence(12, 30_000) + " end"),
        (14, "a b c"),
        (14, "a b c"),
        (15, "\x00 nul   hard space" + " | | |" * 20),
        (None, sentence(1, 120)),
        (None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The rows in several partitions, with extra columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), 0, "x", None) for i, t in edge_rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key int, tag string, fp long"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
