import random

import pytest

from tidemark.llm.common import reachable

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, fp string, size long"


def made_up(n=60, seed=5):
    """Texts with exact and near copies, shared passages, and every odd case the operators name."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "tion", "th", "ou", "é", "ñ"]) for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(70))
    texts = []
    for i in range(n):
        body = " ".join(word() for _ in range(rng.randint(5, 150)))
        if i % 5 == 0:
            body += "\n" + passage + ". " + word()
        if i % 7 == 3 and texts:
            body = texts[rng.randrange(len(texts))]
        if i % 7 == 5 and texts:
            body = texts[rng.randrange(len(texts))] + " " + word()
        texts.append(body)
    rows = [(i, t, "en", f"s{rng.randrange(4)}" if i % 9 else None, len(t)) for i, t in enumerate(texts)]
    rows += [(200, None, None, "s0", None), (201, "", "en", "s1", 0), (202, " \n\t ", "en", None, 4),
             (203, "word " * 30_000, "en", "s2", 150_000), (204, "x" * 40_000, "en", "s2", 40_000),
             (205, "one two", "en", "s1", 7), (None, texts[0], "en", "s1", 9), (None, None, None, None, None),
             (7, texts[7], "en", "s0", 1), (7, texts[7], "en", "s0", 1), (206, "<|endoftext|>b İ é ☃", "en", "s3", 1),
             (207, "dup dup dup " * 40, "en", "s3", 1), (-3, passage, "en", "s3", 1)]
    return [(*r, "clash", "clash", -1) for r in rows]


@pytest.fixture(scope="session")
def docs(spark):
    """The made-up table, in several partitions, with columns that clash with names the operators use."""
    return reachable(spark).createDataFrame(made_up(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def five(spark):
    """The same rows with the columns of documents only."""
    return spark.createDataFrame([r[:5] for r in made_up()], COLUMNS.split(", TEXT")[0]).repartition(3)


@pytest.fixture(scope="session")
def plain(docs):
    return [(r[0], r[1], r[3]) for r in docs.collect()]


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter("false")
