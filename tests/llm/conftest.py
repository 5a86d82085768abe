import random

import pytest
from pyspark.sql import types as T

# Extra columns have names that operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("id", T.LongType()), T.StructField("n_words", T.StringType()), T.StructField("place", T.StringType()),
    T.StructField("found", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("c0", T.StringType()),
])


def made_rows():
    """Copies, near copies, shared passages, lines and strings, missing and empty values."""
    pick = random.Random(5)
    vocabulary = ["".join(pick.choice("abcdeéñ") for _ in range(pick.randint(1, 7))) for _ in range(300)]

    def words(n):
        return [pick.choice(vocabulary) for _ in range(n)]

    passage, line = words(40), " ".join(words(9))
    base = words(120)
    texts = []
    for i in range(30):
        body = words(pick.randint(20, 90))
        if i % 3 == 0:
            body[5:5] = passage[: pick.randint(15, 40)]
        if i % 4 == 0:
            body[-4:-4] = ["\n" + line + "\n"]
        texts.append(" ".join(body))
    for i in range(8):  # near copies
        copy = list(base)
        copy[i * 7] = "changed" + str(i)
        texts.append(" ".join(copy))
    texts += [texts[3]] * 4 + [" ".join(base)] * 2
    texts += ["", " ", "\n", "one", "One", "a b c", "A B C", "x " * 60, ("ab" * 150), ("ab" * 150) + "!", "\t" + line.upper() + "  "]
    texts += [None, " ".join(words(900)), "é" * 40 + "\n" + "é" * 40]
    order = list(range(len(texts)))
    pick.shuffle(order)
    rows = [(i, texts[i], f"s{i % 4}" if i % 7 else None) for i in order]
    rows += [rows[0], rows[1]]  # repeated rows
    return [(*r, 1, None, "p", "f", "s", "c") for r in rows]


@pytest.fixture(scope="session")
def rows():
    return made_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def nameless(spark):
    """Rows without doc_id beside others."""
    text = " ".join(f"w{i}" for i in range(40))
    return spark.createDataFrame([(None, text, None, *[None] * 6), (3, text, "a", *[None] * 6), (5, None, "a", *[None] * 6)], SCHEMA)
