import random

import pytest

WORDS = "the of and to in is that for was on with as be by are this at from river stone light".split()
NASTY = "frobnik"


def text(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(60)) if rng.random() < 0.6 else "") for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): nulls, empty and very long texts, copies, near copies, a shared passage, ties."""
    rng = random.Random(1)
    texts = [text(rng, rng.randrange(20, 200)) for _ in range(40)]
    shared = text(rng, 60)
    texts += [f"{text(rng, 30)} {shared} {text(rng, 30)}" for _ in range(6)]
    base = text(rng, 300).split()
    texts += [" ".join(base)] * 3
    for i in range(4):
        near = list(base)
        near[17 * i] = f"changed{i}"
        texts.append(" ".join(near))
    texts += [None, "", " \n\t ", "one", "two words", "123 456", "Über ñandú  zwei\n\nGrün", "x" * 5000]
    texts += [" ".join(text(rng, 1).split() * 100), "All rights reserved.\nAll rights reserved. CC-BY 4.0", text(rng, 20_000)]
    texts += ["This work is licensed under the GNU General Public License, version 3 of it"]
    rows = [(3 * i + 1, t, None if i % 11 == 0 else ("aa", "bb")[i % 2], None if i % 13 == 0 else f"s{i % 4}") for i, t in enumerate(texts)]
    random.Random(2).shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, words string, n_words int, score double, tie int"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with more columns whose names operators use themselves."""
    rows = [(*r, None, 1, 0.5, 7) for r in corpus]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
