import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(r, n, vocabulary=400):
    return " ".join(f"w{r.randint(0, vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Small, with copies, near copies, shared passages, long runs, nulls, empties and repeated rows."""
    r = random.Random(11)
    out = []
    base = [sentence(r, r.choice([1, 4, 5, 12, 13, 14, 60, 200])) for _ in range(60)]
    base += ["", None, "   \n\t ", "a b c", "A B C", "a " * 300, "x" * 500, "x" * 199, "é" * 150, "b " * 13]
    passage = sentence(r, 60)
    for i in range(12):
        base.append(f"{sentence(r, r.randint(0, 30))} {passage} {sentence(r, r.randint(0, 30))}")
    for i in range(10):
        words = base[7 + i].split() * 3
        for _ in range(i):
            words[r.randrange(len(words))] = "changed"
        base += [" ".join(words), " ".join(words).upper()]
    for i, text in enumerate(base):
        out.append((i, text, "en", r.choice(["a", "b", None, "c"]), None if text is None else len(text)))
    out += [out[20], out[20], (None, base[21], "en", "a", 1), (None, base[21], None, None, None), (None, None, "en", "b", None), (500, base[7], "de", "b", 5), (500, base[9], "de", "b", 5)]
    r.shuffle(out)
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
