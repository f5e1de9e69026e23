import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that the operators also use inside
          "row string, k string, t string, code string, kept string, lines string, n string, block string, h long")


def words(rnd: random.Random, n: int) -> str:
    stems = ["the", "of", "and", "thion", "ering", "hand", "blest", "onto", "wher", "ésta", "größe"]
    return " ".join("".join(rnd.choice(stems) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def rows(texts):
    return [(i, x, "en", "s", None, "r", "k", None, "c", None, "l", "n", "b", i) for i, x in texts]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) of ordinary texts with copies, near copies, repeated lines, long, empty and null texts."""
    rnd = random.Random(7)
    base = [words(rnd, rnd.randint(1, 120)) for _ in range(30)]
    shared = "\n".join(words(rnd, 9) for _ in range(5))
    texts = list(base)
    texts += [base[0], base[0], base[1] + " more", base[2].upper(), base[3].replace("the", "teh", 1)]
    texts += [base[4] + "\n" + shared + "\n" + base[5], base[6] + "\n" + shared, shared]
    texts += ["\n".join(["same line"] * 6), "a\nb", "", " ", None, "\n\n\n", "one", "one two", "Thé  two\tspaces\r\n x"]
    texts += ["###" + " |" * 30, "word " * 200, "x" * 5000, words(rnd, 9000), "<|endoftext|> </s>[INST] ok"]
    found = [(i * 3, x) for i, x in enumerate(texts)]
    return found + [found[5], found[5], (None, "no id"), (None, None), (21, "another text of one id")]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(rows(corpus), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def many_parts(spark):
    """Small partitions stay apart."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)
