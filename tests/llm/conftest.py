"""Fixtures of the training-data operators: a small documents table with every odd case."""

import pytest
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use inside, as columns of the input
          "piece int, length string, kept boolean, node long, words string, ids string, "
          "shard int, first string, label int, n_words long, key string")

BASE = ("Wh inan the lythe of on ner and thon hed wher anded for the lines of this text that "
        "goes on for a while and ends here.")


def odd_rows():
    long = " ".join(f"word{i % 977} the of and" for i in range(20_000))
    texts = [
        None, "", "   ", "\n\n", "one", "two words", "<|endoftext|> x<|endoftext|>y",
        BASE, BASE, BASE.replace("while", "moment"), BASE + "\n" + BASE,
        BASE + "\nEén façade où l'été naïve ß übergeht zu den Straßen der Stadt im Jahr 1999!",
        "$$$ ### ***\n" * 30, "BUY NOW!! " * 40, "日本語のテキスト\n日本語のテキスト 한국어",
        "tabs\tand\x0bother\x0cspaces\r\nhere  double  blanks \n trailing ", "a" * 5000,
        "nul \x00 byte and   separators \xa0 here", "\U0001f600 é İ ǅ ΑΣ", long]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, "\n\n"), (7, BASE), (7, BASE)]                 # rows that repeat
    rows += [(50, "tie one of two for id fifty"), (50, "tie two of two for id fifty")]
    rows += [(None, BASE), (None, None), (None, "a null id with words of its own")]
    out = []
    for i, t in rows:
        lang = [None, "en", "de", "xx"][(i or 0) % 4]
        out.append((i, t, lang, "src", None if t is None else len(t), 9, "x", False, 1, "w", "i",
                    99, "f", 3, 7, "k"))
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def sample(spark, sf_small):
    """The documents of the smallest test data, with clashing extra columns."""
    d = spark.read.parquet(f"{sf_small}/documents.parquet")
    return d.withColumns({"piece": F.lit(9), "node": F.lit(1), "kept": F.lit(False)}).cache()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)

