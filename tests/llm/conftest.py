import random

import pytest

SYLLABLES = "ka lo mi ten sur vel dor pin gra shu fen bol".split()


def prose(seed, n_words, rng=None):
    """Invented words; lines of about a dozen."""
    r = rng or random.Random(seed)
    words = ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n_words)]
    return "\n".join(" ".join(words[a:a + 12]) for a in range(0, n_words, 12))


def edited(text, seed, share):
    r = random.Random(seed)
    return " ".join("zq" + w if r.random() < share else w for w in text.replace("\n", " \n ").split(" "))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies at all distances, short, empty and null ones."""
    rows = []
    for k in range(30):
        rows.append(prose(k, [4, 9, 25, 60, 200, 500][k % 6]))
    for k in range(30):
        for s in (0.0, 0.01, 0.03, 0.06):
            rows.append(edited(rows[k], 100 * k + int(100 * s), s))
    rows += [None, "", "  \n\t ", "one", "One", "two words", "TWO words", rows[4], rows[4], "日本 語 x é"]
    return list(enumerate(rows, 1))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, comp long, sig long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns that clash with the operators' working names."""
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 11 == 0 else f"src{i % 2}", len(t or ""), -i, 0, 5, None) for i, t in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
