import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def hard_rows():
    """Documents with nulls, empty and very long texts, ties, copies and shared passages."""
    random.seed(3)
    vocabulary = ["".join(random.choice("abcdefghij") for _ in range(random.randint(1, 8))) for _ in range(4000)]
    passage = lambda n: [random.choice(vocabulary) for _ in range(n)]
    shared, other, base = passage(70), passage(55), passage(120)
    texts = [" ".join(passage(random.randint(8, 150))) for _ in range(40)]
    texts += [" ".join(passage(20) + shared + passage(20)) for _ in range(6)]
    texts += [" ".join(shared[10:65] + other), " ".join(other + passage(3) + shared[:49]), " ".join(shared + shared)]
    for _ in range(14):  # near copies of one text, each with its own edits
        copy = list(base)
        for _ in range(random.randint(0, 3)):
            copy[random.randrange(len(copy))] = random.choice(vocabulary)
        texts.append(" ".join(copy).upper() if random.random() < 0.2 else "\n".join(copy))
    texts += [" ".join(passage(30_000)), "x" * 200_000, "", " \n\t ", None, "one", "one", "One two", "é ü ß"]
    texts += ["same line\n" * 30, "a b c d e " * 40, "### $$$ |||" * 20]
    rows = [(i * 3 % 97, t, random.choice(["en", "fr", None]), random.choice(["s1", "s1", "s2", None]),
             len(t) if t else None) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], rows[41], (rows[42][0], "another text under a known id " * 9, "en", "s1", 1)]
    rows += [(None, texts[41], None, None, None), (None, " ".join(base), "en", "s1", 5), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def hard_documents(spark, hard_rows):
    return spark.createDataFrame(hard_rows, DOCUMENTS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
