import random

import pytest

WORDS = "the and of river stone quiet Licence über naïve 日本 42 x-ray don't".split()


def text(r, n):
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """doc_id, text: nulls, empties, short and long texts, ties, repeated rows, near copies, a long text without breaks."""
    r = random.Random(11)
    base = [text(r, 120) for _ in range(12)]
    out = [(i, t) for i, t in enumerate(base)]
    out += [(100 + i, base[0]) for i in range(5)]  # equal texts
    out += [(200 + i, base[1].replace("river", "lake", 1) + " end") for i in range(3)]  # near copies
    out += [(300, None), (301, ""), (302, " \n\t "), (303, "one two"), (304, "one two"), (305, "ONE two"), (None, base[2]), (None, None)]
    out += [(400, "a" * 5000), (401, text(r, 4000)), (402, "日本" * 3000), (403, "\n".join(["same line here"] * 80)), (404, "x <|endoftext|> y"), (405, base[3]), (405, base[3])]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """With columns that operators don't ask for, some with names that they use inside."""
    return spark.createDataFrame([(i, t, "en", i, "s", [1], "k") for i, t in rows], "doc_id long, text string, lang string, id long, key string, ids array<int>, c string").cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
