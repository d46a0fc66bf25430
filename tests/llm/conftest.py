import random

import pytest

WORDS = "alpha beta gamma delta the of and river stone light über naïve 漢字 token license under by nc".split()
PASSAGE = " ".join(f"passage{i}" for i in range(60))


def text(rng, n):
    out = []
    for _ in range(n):
        out.append(rng.choice(WORDS) + str(rng.randint(0, 400)) * (rng.random() < 0.7))
        if rng.random() < 0.08:
            out.append("\n")
    return " ".join(out).replace(" \n ", "\n")


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): random texts, copies, near copies, shared passages, nulls, blanks, a very long text and a repeated row."""
    rng = random.Random(7)
    out = [(i, text(rng, rng.randint(1, 120))) for i in range(60)]
    long_text = text(rng, 400)
    out += [(60, out[3][1]), (61, out[3][1].upper()), (62, long_text), (63, long_text + " x"), (64, None), (65, ""), (66, " \n\t "), (67, text(rng, 6000))]
    out += [(68, "start a\n" + PASSAGE + "\nend"), (69, "other b\n" + PASSAGE + "\nfin"), (70, PASSAGE + "\n" + PASSAGE), (None, out[5][1]), (None, None)]
    out += [(71, "one two three"), (72, "one two"), (71, "one two three"), (73, "!!! ??? 123"), (74, out[10][1] + "\n" + out[11][1])]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table, with further columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", 1, "x") for i, t in rows], "doc_id long, text string, lang string, fp int, hits string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
