"""Batch jobs over the three collections -- the runnable form of the library.

Each job reads ``business`` / ``review`` / ``user`` through a :class:`Catalog`
(any Spark data source), runs one recommender as a single plan, and writes its
result tables with the sinks (append by default, as the original jobs did).

    python -m tastemesh social --input /data/collections --format json --output /out/rec

Jobs chain: what one writes, the next reads as its input (``OUT/business`` is a
table of the root ``OUT``).  Each derived table that several results read is
written once and read back.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemesh.schema import SCHEMAS
from tastemesh.operators import collaborative as CF
from tastemesh.operators import content as C
from tastemesh.operators import index as IX
from tastemesh.operators import preprocess as P
from tastemesh.operators import social as SO
from tastemesh.operators import text as TX
from tastemesh.operators.hybrid import hybrid_recommendations
from tastemesh.functions.strings import parse_id_list
from tastemesh.session import cut_lineage
from tastemesh.sources import commits, sinks
from tastemesh.sources.catalog import Catalog
from tastemesh.sources.models import load_als, save_als


def preprocess_job(cat: Catalog, out: str, city: str = "Las Vegas",
                   category: str = "restaurants", mode: str = "append",
                   job: str | None = None) -> None:
    """Filtered business / review / user tables and the review_context table."""
    b, r, u = cat.load("business"), cat.load("review"), cat.load("user")
    # the filtered businesses feed every other table: evaluated once
    bf = cut_lineage(P.business_in_category(b, category, city), required=True)
    rf, uf = P.cascade(bf, r, u)
    sinks.write_table(bf, f"{out}/business", mode=mode, job=job)
    sinks.write_table(rf, f"{out}/review", mode=mode, job=job)
    sinks.write_table(uf, f"{out}/user", mode=mode, job=job)
    sinks.write_table(P.review_context(r, bf, city), f"{out}/review_context", mode=mode,
                      job=job)


def topical_job(cat: Catalog, out: str, category: str = "restaurants", mode: str = "append") -> None:
    """Tab-separated topical lines (category filter in any city)."""
    t = P.topical_join(cat.load("business"), cat.load("review"), cat.load("user"), category)
    sinks.write_lines(P.topical_lines(t), out, mode=mode)


def collaborative_job(cat: Catalog, out: str, model_path: str, k: int = 10, seed: int = 42,
                      mode: str = "append", num_blocks: int = CF.NUM_BLOCKS,
                      job: str | None = None) -> float:
    """Index → split → ALS → RMSE → top-k lists; the model is saved with its
    indexes.  Returns the test RMSE."""
    r, u, b = cat.load("review"), cat.load("user"), cat.load("business")
    ui = IX.dense_index(u, "user_id", "user_idx")
    bi = IX.dense_index(b, "business_id", "business_idx")
    triples = cut_lineage(IX.rating_triples(r, ui, bi, keep=("review_id",)), required=True)
    train, test = CF.train_test_split(triples, ["review_id"], seed=seed)
    model = CF.fit(train, seed=seed, num_blocks=num_blocks)
    rmse = CF.rmse(CF.predictions(model, test))
    save_als(model, ui, bi, model_path)
    recs = CF.with_string_ids(CF.recommend_exploded(model, k), ui, bi)
    sinks.write_table(CF.ranked_lists(recs), out, mode=mode, job=job)
    return rmse


def model_recommendations_job(spark: SparkSession, model_path: str, out: str, k: int = 10,
                              mode: str = "append", job: str | None = None) -> None:
    """Top-k for all users from a saved model, ids mapped back."""
    model, ui, bi = load_als(spark, model_path)
    recs = CF.with_string_ids(CF.recommend_exploded(model, k), ui, bi)
    sinks.write_table(CF.ranked_lists(recs), out, mode=mode, job=job)


def business_vectors(review: DataFrame) -> DataFrame:
    """(business_id, vector): Word2Vec (the pipeline's vector stage, same
    parameters) fitted on the review tokens; mean word vector per business
    over all its reviews' tokens.  The pipeline's count/IDF stages are not
    fitted here: the recommender reads only the word vectors."""
    toks = TX.tokens(review.select("review_id", "business_id", "text"))
    w2v = TX.word2vec_stage().fit(toks)
    return TX.mean_word_vectors(toks, "business_id", TX.word_vectors(w2v))


def content_job(cat: Catalog, out: str, k: int = 10, neighbours: int = 10,
                vectors: DataFrame | None = None, mode: str = "append",
                job: str | None = None) -> None:
    """Content recommendations as ``(user_id, business_id 'id id id')`` lines
    and as a ranked table with business details, and the vectors and lists behind them.

    Vectors and lists are evaluated once, into checkpoints of this run; all four
    tables are written under ``mode``, so an append deletes nothing of a former run."""
    r, b = cat.load("review"), cat.load("business")
    if vectors is None:
        vectors = cut_lineage(business_vectors(r), required=True)
        sinks.write_table(vectors, f"{out}/vectors", mode=mode, job=job)
    recs = cut_lineage(C.content_recommendations(r, b, vectors, k=k, neighbours=neighbours),
                       required=True)
    sinks.write_table(recs, f"{out}/recs", mode=mode, job=job)
    sinks.write_table(C.rec_lines(recs), f"{out}/lines", mode=mode, job=job)
    sinks.write_table(C.with_details(recs, b), f"{out}/details", mode=mode, job=job)


def social_job(cat: Catalog, out: str, k: int = 10, levels: int = 3,
               mode: str = "append", city: str | None = None,
               category: str | None = None, job: str | None = None) -> None:
    """Social recommendations (user_id, business_id, top_reviews, rank).

    With a city and a category the collections first pass the preprocessing
    cascade: businesses, then their reviews, then the users who wrote them."""
    u, r = cat.load("user"), cat.load("review")
    if city and category:
        bf = P.business_in_category(cat.load("business"), category, city)
        r = P.semi_join(r, bf, "business_id")
        u = P.semi_join(u, r, "user_id")
    recs = SO.social_pipeline(u, r, k=k, levels=levels)
    sinks.write_table(recs, out, mode=mode, job=job)


def hybrid_job(spark: SparkSession, cat: Catalog, sources: dict[str, str], out: str,
               fmt: str = "parquet", mode: str = "append", job: str | None = None) -> None:
    """Tagged union of saved recommendation tables with business details.

    ``sources`` maps a type name to a table of (user_id, business_id, rank).
    Lists are exploded in their order: arrays of ids, and the stored text form
    ``id id id`` of the content job's lines (a table without ranks).
    """
    parts = []
    for name, path in sources.items():
        df = commits.load(spark, path, fmt)
        if "rank" not in df.columns:
            if not dict(df.dtypes)["business_id"].startswith("array"):
                df = df.withColumn("business_id", parse_id_list("business_id", " "))
            df = df.select("user_id", F.posexplode("business_id").alias("_p", "business_id")) \
                   .withColumn("rank", F.col("_p") + 1).drop("_p")
        parts.append((name, df))
    sinks.write_table(hybrid_recommendations(parts, cat.load("business")), out, mode=mode,
                      job=job)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tastemesh")
    ap.add_argument("job", choices=["preprocess", "topical", "collaborative", "model-recs",
                                    "content", "social", "hybrid"])
    ap.add_argument("--input", required=True, help="root of the business/review/user tables")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--output", required=True)
    ap.add_argument("--mode", default="append", choices=["append", "overwrite"])
    ap.add_argument("--suffix", default="", help="ending of table names, e.g. .parquet")
    ap.add_argument("--city", default="Las Vegas",
                    help="preprocess, social; empty: no city and category filter (social)")
    ap.add_argument("--category", default="restaurants", help="preprocess, topical, social")
    ap.add_argument("--blocks", type=int, default=CF.NUM_BLOCKS,
                    help="ALS user and item blocks (collaborative)")
    ap.add_argument("--k", type=int, default=10)
    ap.add_argument("--model", help="ALS model folder (collaborative, model-recs)")
    ap.add_argument("--source", action="append", default=[],
                    help="hybrid input as type=path (repeatable, in order)")
    ap.add_argument("--run", help="name of this run: its rows count once however often it is "
                                  "repeated (tables of commits; not for topical lines)")
    a = ap.parse_args(argv)
    if a.run and a.job == "topical":
        ap.error("topical writes text lines, which are no table of commits")
    if a.job in ("collaborative", "model-recs") and not a.model:
        ap.error(f"{a.job} needs --model")
    spark = SparkSession.builder.appName(f"tastemesh-{a.job}").getOrCreate()
    cat = Catalog(spark, a.input, fmt=a.format,
                  schemas=SCHEMAS if a.format == "json" else {}, suffix=a.suffix)
    if a.job == "preprocess":
        preprocess_job(cat, a.output, a.city, a.category, a.mode, job=a.run)
    elif a.job == "topical":
        topical_job(cat, a.output, a.category, a.mode)
    elif a.job == "collaborative":
        print("rmse", collaborative_job(cat, a.output, a.model, a.k, mode=a.mode,
                                        num_blocks=a.blocks, job=a.run))
    elif a.job == "model-recs":
        model_recommendations_job(spark, a.model, a.output, a.k, a.mode, job=a.run)
    elif a.job == "content":
        content_job(cat, a.output, a.k, mode=a.mode, job=a.run)
    elif a.job == "social":
        social_job(cat, a.output, a.k, mode=a.mode, city=a.city, category=a.category, job=a.run)
    elif a.job == "hybrid":
        hybrid_job(spark, cat, dict(s.split("=", 1) for s in a.source), a.output, mode=a.mode,
                   job=a.run)
