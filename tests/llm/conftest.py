import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"{rng.choice('abcdefgh')}{rng.randrange(vocabulary)}x" for _ in range(n)]


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, empty and null ones, a long one, other scripts and odd white space."""
    rng = random.Random(7)
    base = [" ".join(words(rng, 60)) + ".\n" + " ".join(words(rng, 40)) + "!" for _ in range(12)]
    near = [b.replace(" ", "  ", 1) + " extra" for b in base[:3]]
    odd = [None, "", "   \n\t ", "one", "Ünï Çödé ÄÖÜ\nzwei DREI", "日本語 テキスト 😀 x", "\n\nA\r\nB\n", "a" * 5000, " ".join(words(rng, 20000))]
    return base + near + base[:2] + odd + ["İstanbul ſ ½ <|endoftext|> it's 12,5%"]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts with ids, the last two rows repeated and one without id."""
    rows = [(k * 3, t, "en", f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    rows += rows[-2:] + [(None, "no id here at all", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clash(docs):
    """The same rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("vector", "words", "n", "key", "ids", "range", "score", "toxic_score", "n_lines", "blob", "spans", "rule", "host", "text_key", "bands", "pos", "term", "held_out", "_order", "_text", "_key", "_id", "_drop", "_text_hash", "own_id", "own_key", "own_score", "drop", "text_hash", "size", "root", "items")
    return docs.select("*", *(F.lit("x").alias(x) for x in names))
