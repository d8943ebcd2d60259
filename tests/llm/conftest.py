import random

import pytest

from txnlens.session import ship_package

CLASH = ("n", "row", "rid", "id", "src", "block", "bucket", "score", "predicted", "next", "cut", "tail", "kept", "epoch", "words", "is_query")
LANGS = ("en", "de", None, "fr")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 7))) for _ in range(n))


def odd_texts():
    """Texts with nulls, empty, blank, tiny, very long, equal, near and
    passage-sharing cases."""
    rng = random.Random(3)
    base, passage = words(rng, 300), words(rng, 60)
    near = base.split()
    near[150] = "changed"
    far = base.split()
    for i in range(0, 300, 9):
        far[i] = "other"
    texts = [None, "", " \n\t", "one", "One", "two words", "two words", base, base, base.upper(), " ".join(near), " ".join(far),
             words(rng, 40) + " " + passage + " " + words(rng, 30), words(rng, 10) + " " + passage, passage, words(rng, 20_000),
             "De " * 400, "De " * 401, "ab" * 300, "\u00e9" * 120, "x\u00e9" * 90, "<|im_end|> 'll don't \u4e2d\u6587 \u0130\u03a3", base[:49], base[:50], base[:51]]
    return texts + [words(rng, rng.randint(1, 120)) for _ in range(30)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with such texts, and further columns with clashing names."""
    rows = [(i * 3, t, LANGS[i % 4], None if i % 7 == 0 else f"s{i % 3}", 0) for i, t in enumerate(odd_texts())]
    from pyspark.sql import functions as F

    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return d.withColumns({c: F.lit("clash") for c in CLASH}).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
