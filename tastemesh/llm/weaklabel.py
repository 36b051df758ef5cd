"""Quality classifier (operator 5): a weak-label model and a hashed linear scorer.

Eight overlapping heuristics look at a text and vote good (1), bad (0) or not at
all.  How often each pattern of votes occurs in the whole corpus (at most 3^8
patterns, whatever its size) is all that expectation-maximisation needs: it
estimates every heuristic's accuracy on good and on bad texts and the share of
good texts, without any label, and gives each pattern its posterior.

The posteriors of a bounded sample of documents (``SAMPLE`` expected, twice that
at most, chosen by a hash of the text) then train a linear scorer on hashed
byte n-grams, with the posteriors as soft targets.  The scorer sees spelling, not
the heuristics, so it generalises over texts on which they abstain.  It scores
every document; those below ``REJECT_BELOW`` are rejected, low enough that a
document goes only when the scorer is sure.

Defined cases: null texts are empty; on an empty text only the length heuristic
votes, and its score is that of no n-grams; repeated rows get equal rows; with
an empty table the scorer is flat and no rows come out; other columns are not
read by :func:`score`, and :func:`quality_filter` returns exactly the input's
columns.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.llm.common import documents, texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 3000
DIMS = 4096
REJECT_BELOW = 0.5
HEURISTICS = ("length", "function_words", "symbols", "capitals", "vocabulary", "repeated_lines",
              "word_length", "punctuation")

# Frequent function words of the languages in question.
FUNCTION_WORDS = frozenset("""
the of and to in a is that it for was on as with be by this are or an at from
der die das und in zu den von mit ist ein eine nicht auf für im dem des sich
le la les de des et en un une que qui dans pour pas sur est du au
el los las y que en un una por con para es se del al lo no su
""".split())
SYMBOLS = "#*$%&|<>"


def votes(text: str) -> list[int]:
    """One vote per heuristic: 1 good, 0 bad, -1 none."""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0] + [-1] * 7
    out = [0 if n < 10 else 1 if n >= 20 else -1]
    common = sum(w in FUNCTION_WORDS for w in text.lower().split()) / n
    out.append(1 if common >= 0.06 else 0 if common < 0.02 and n >= 20 else -1)
    symbols = sum(map(text.count, SYMBOLS)) / n
    out.append(0 if symbols > 0.3 else 1 if symbols <= 0.05 else -1)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    upper = int(((codes >= 65) & (codes <= 90) | (codes >= 0xC0) & (codes <= 0xDE)).sum())
    lower = int(((codes >= 97) & (codes <= 122) | (codes >= 0xDF) & (codes <= 0xFF)).sum())
    share = upper / max(upper + lower, 1)
    out.append(-1 if upper + lower < 20 else 0 if share > 0.4 else 1 if share < 0.2 else -1)
    distinct = len(set(words)) / n
    out.append(-1 if n < 50 else 1 if distinct >= 0.4 else 0 if distinct < 0.2 and n < 2000 else -1)
    lines = [line for line in text.split("\n") if line.strip()]
    repeated = 1 - len(set(lines)) / len(lines)
    out.append(0 if repeated > 0.3 else 1 if repeated == 0 and len(lines) >= 3 else -1)
    mean = sum(map(len, words)) / n
    out.append(0 if mean > 10 or mean < 2 else 1 if 3 <= mean <= 6.5 else -1)
    shouts = (text.count("!!") + text.count("|")) / n
    ends = sum(map(text.count, ".!?")) / n
    out.append(0 if shouts > 0.3 else 1 if 0.01 <= ends <= 0.5 else -1)
    return out


def pattern_code(vote: list[int]) -> int:
    return sum((v + 1) * 3 ** i for i, v in enumerate(vote))


def pattern_votes(code: np.ndarray, k: int = len(HEURISTICS)) -> np.ndarray:
    return np.stack([code // 3 ** i % 3 - 1 for i in range(k)], axis=1)


def fit_votes(code: np.ndarray, n: np.ndarray, rounds: int = 200) -> dict:
    """Expectation-maximisation over vote patterns and their numbers.

    Returns the share of good texts, every heuristic's accuracy on good and on bad
    texts, and the posterior (of good) per pattern.  An abstention says nothing.
    Heuristics are held to be no worse than chance, which fixes what is good.
    """
    v = pattern_votes(code)
    good, bad, prior = np.full(v.shape[1], 0.8), np.full(v.shape[1], 0.8), 0.8
    post = np.full(len(code), prior)
    for _ in range(rounds):
        log_good = np.log(prior) + np.where(v == 1, np.log(good), np.where(
            v == 0, np.log1p(-good), 0.0)).sum(axis=1)
        log_bad = np.log1p(-prior) + np.where(v == 0, np.log(bad), np.where(
            v == 1, np.log1p(-bad), 0.0)).sum(axis=1)
        new = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        done = len(new) == 0 or np.abs(new - post).max() < 1e-9
        post = new
        wg, wb = (n * post)[:, None], (n * (1 - post))[:, None]
        good = ((wg * (v == 1)).sum(axis=0) + 8) / ((wg * (v >= 0)).sum(axis=0) + 10)
        bad = ((wb * (v == 0)).sum(axis=0) + 8) / ((wb * (v >= 0)).sum(axis=0) + 10)
        good, bad = np.clip(good, 0.5, 0.999), np.clip(bad, 0.5, 0.999)
        prior = float(np.clip((wg.sum() + 8) / (n.sum() + 10), 0.01, 0.99))
        if done:
            break
    return {"prior": prior, "good": good, "bad": bad,
            "posterior": dict(zip(code.tolist(), post.tolist()))}


def features(text: str, dims: int = DIMS) -> np.ndarray:
    """Hashed counts of the byte 1-, 2- and 3-grams of a text, dampened, of length 1."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    x = np.zeros(dims, np.float32)
    gram = np.zeros(len(b), np.uint32)
    for k in range(1, 4):
        if len(b) < k:
            break
        gram = gram[:len(b) - k + 1] * np.uint32(257) + b[k - 1:] + np.uint32(k)
        x += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(8) & np.uint32(dims - 1),
                         minlength=dims)
    x = np.log1p(x)
    return x / max(float(np.sqrt((x * x).sum())), 1e-9)


def fit_scorer(x: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 4.0,
               decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by gradient descent with momentum."""
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    if not len(x):
        return w, b
    target = target.astype(np.float32)
    b = float(np.log(target.mean().clip(1e-3, 1 - 1e-3) / (1 - target.mean().clip(1e-3, 1 - 1e-3))))
    mean = x.mean(axis=0)
    centred = x - mean
    vw, vb = np.zeros_like(w), 0.0
    for _ in range(rounds):
        err = 1 / (1 + np.exp(-(centred @ w + np.float32(b)))) - target
        vw = np.float32(0.9) * vw - np.float32(rate) * (err @ centred / np.float32(len(x))
                                                         + np.float32(decay) * w)
        vb = 0.9 * vb - rate * 0.1 * float(err.mean())
        w, b = w + vw, b + vb
    return w, float(b - mean @ w)


def fit(docs: DataFrame, sample: int = SAMPLE, dims: int = DIMS) -> dict:
    """The weak-label model and the scorer of a documents table."""
    docs = texts(docs)

    def count(batches):
        for batch in batches:
            code = np.fromiter((pattern_code(votes(t)) for t in batch.column("text").to_pylist()),
                               np.int32, batch.num_rows)
            c, n = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(n, pa.int64())],
                                             names=["code", "n"])

    found = (docs.select("text").mapInArrow(count, "code int, n long").groupBy("code")
             .agg(F.sum("n").alias("n")).orderBy("code").toArrow())     # at most 3^8 rows
    model = fit_votes(found.column("code").to_numpy().astype(np.int64),
                      found.column("n").to_numpy().astype(np.float64))
    n_docs = int(found.column("n").to_numpy().sum())
    share = min(1.0, sample / max(n_docs, 1))
    # each distinct text counts once, and which texts the limit keeps is fixed by their hashes
    drawn = (docs.select("text", F.xxhash64("text").alias("draw"),
                         F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 30)).alias("lot"))
             .filter(F.col("lot") < int(share * (1 << 30)))
             .groupBy("lot", "draw").agg(F.first("text").alias("text"))
             .orderBy("lot", "draw").limit(2 * sample).select("text", "draw"))

    def look(batches):
        for batch in batches:
            rows = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("draw"), pa.array([pattern_code(votes(t)) for t in rows], pa.int32()),
                 pa.array([features(t, dims).astype(np.float16).tobytes() for t in rows],
                          pa.binary())], names=["draw", "code", "x"])

    seen = drawn.mapInArrow(look, "draw long, code int, x binary").toArrow()  # <= 2 * sample rows
    seen = seen.sort_by([("draw", "ascending"), ("code", "ascending")])
    x = np.frombuffer(b"".join(seen.column("x").to_pylist()), np.float16).reshape(-1, dims)
    target = np.array([model["posterior"][c] for c in seen.column("code").to_pylist()])
    model["weights"], model["bias"] = fit_scorer(x.astype(np.float32), target)
    return model


_SCORED = T.StructType([T.StructField("votes", T.StringType()),
                        T.StructField("posterior", T.DoubleType()),
                        T.StructField("score", T.DoubleType()),
                        T.StructField("kept", T.BooleanType())])


def scored_udf(model: dict, reject_below: float = REJECT_BELOW):
    """A pandas UDF text -> (votes, posterior, score, kept)."""
    weights, bias, posterior = model["weights"], model["bias"], model["posterior"]
    prior = model["prior"]

    @F.pandas_udf(_SCORED)
    def run(text: pd.Series) -> pd.DataFrame:
        rows = []
        for t in text:
            t = t or ""
            v = votes(t)
            z = float(features(t, len(weights)) @ weights) + bias
            score = 1 / (1 + np.exp(-z))
            rows.append(("".join("-01"[x + 1] for x in v),
                         posterior.get(pattern_code(v), prior), score, bool(score >= reject_below)))
        return pd.DataFrame(rows, columns=_SCORED.names)
    return run


def score(docs: DataFrame, model: dict | None = None,
          reject_below: float = REJECT_BELOW) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) of every document."""
    model = model or fit(docs)
    return (texts(docs).withColumn("s", scored_udf(model, reject_below)("text"))
            .select("doc_id", "s.*"))


def quality_filter(docs: DataFrame, text_col: str = "text", model: dict | None = None,
                   reject_below: float = REJECT_BELOW) -> DataFrame:
    """The documents that the scorer keeps, with all columns of the input."""
    model = model or fit(docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")))
    return docs.filter(scored_udf(model, reject_below)(docs[text_col].cast("string"))["kept"])


def op5_weak_label_scorer(spark, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
