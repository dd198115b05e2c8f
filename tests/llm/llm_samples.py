"""A small corpus with every odd case, shared by the tests of this folder."""

import random

import pytest

SYLLABLES = "the of and tion er in re st ed on ha al or en ti es is be to nd".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))
                    for _ in range(n))


def edited(rng, text, times=1):
    w = text.split(" ")
    for _ in range(times):
        w[rng.randrange(len(w))] = "zz" + rng.choice(SYLLABLES)
    return " ".join(w)


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source): copies, near copies, shared passages,
    short, empty, null and very long texts, a null id and a null source."""
    rng = random.Random(11)
    base = [prose(rng, rng.randint(30, 120)) for _ in range(14)]
    passage = prose(rng, 60)
    texts = [*base, *[base[0]] * 5, *[edited(rng, base[1]) for _ in range(8)],
             *[edited(rng, base[2], 2) for _ in range(4)],
             *[prose(rng, 20) + "\n" + passage + " " + prose(rng, 15) for _ in range(5)],
             None, "", " \n\t ", "one", "one two three", "One TWO three", "été 中文 \U0001f600 x",
             "ab " * 400, "12 34 -- 56", prose(rng, 9000), base[3] + "\n\n" + base[4]]
    rng.shuffle(texts)
    rows = [(i * 3 - 5, t, "en", None if i % 11 == 0 else f"s{i % 4}") for i, t in enumerate(texts)]
    return rows + [(None, base[5], None, "s1")]


CLASHES = ["bucket", "grp", "size", "key", "node", "range", "label", "block", "u", "v", "shard",
           "score", "n", "target", "curve", "ids"]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(corpus, "doc_id long, text string, lang string, source string")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES]).repartition(5)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
