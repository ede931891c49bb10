import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
                            "score double, doc string, size string, node string, `a.b` int")
LABELS = "doc_id long, quality int, toxic int"
GOOD = "river stone garden winter morning harbour letter window candle bridge meadow silver".split()
EVIL = "grobak zulfit mordan".split()


def prose(r: random.Random, n: int, words=GOOD) -> str:
    return " ".join(f"{r.choice(words)}{r.choice(['', 'a', 'en', 'ol'])}" for _ in range(n))


def doc(i, text, lang="en", source="s0"):
    """A row whose extra columns clash with names that the operators use."""
    return (i, text, lang, source, len(text or ""), 9.0, "x", "y", "z", 1)


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in any column, empty and blank texts, a very long text, ties and repeated rows."""
    r = random.Random(1)
    long = prose(r, 30_000)
    same = prose(r, 40)
    return [doc(1, None), doc(2, ""), doc(3, " \t\n "), doc(4, long), doc(5, same), doc(5, same), doc(6, same),
            (None, "no id here at all", None, None, None, None, None, None, None, None),
            doc(7, "Ünïcödé 東京 \U0001f600 ½"), doc(8, "one"), doc(9, same, None, None),
            (10, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="session")
def corpus():
    """(documents, labels): 300 texts; label words mark toxic ones, signs after words poor ones."""
    r = random.Random(7)
    docs, labels = [], []
    for i in range(300):
        text = prose(r, r.randint(20, 200))
        toxic, poor = i % 5 == 0, i % 4 == 1
        if toxic:
            words = text.split()
            for w in r.choices(EVIL, k=3):
                words.insert(r.randrange(len(words)), w)
            text = " ".join(words)
        if poor:
            text = " ".join(w + "###" for w in text.split())
        docs.append(doc(i, text, "en", f"s{i % 3}"))
        if i % 3:
            labels.append((i, int(not poor), int(toxic)))
    return docs, labels


@pytest.fixture(scope="session")
def labels_of(spark):
    return lambda rows: spark.createDataFrame(rows, LABELS)
