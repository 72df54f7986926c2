import os
import random

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score string, shard string, kept string, bk string"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def _texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.randint(12, 90))) for _ in range(24)]
    out = list(base)
    for i, t in enumerate(base[:12]):  # near copies, some with very many changes, and exact copies
        for changes in (1, 2, 4, 9):
            words = t.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            out.append(" ".join(words))
        out += [t.upper(), t] * (i % 3)
    out += [None, "", "   \t\n", "one", "ONE", "one two three", "mail a.b@c.de or +49 30 1234567890", "café \U0001f600 " * 5, "word " * 30_000 + base[0]]
    return out


@pytest.fixture(scope="session")
def doc_rows():
    rows = [(i * 7 % 1000, t, [None, "en", "de"][i % 3], f"s{i % 4}" if i % 9 else None, None, "x", "y", None, "z", "") for i, t in enumerate(_texts())]
    return rows + [rows[3], rows[3], rows[40], (None, rows[5][1], None, None, None, None, None, None, None, None), (None, None, "en", "s1", 0, "", "", "", "", "")]


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
