"""Indexing, rating triples, text and collaborative queries (W1, J1, J2, J9,
X4, X5, A2, A5, A7, M1-M13, S8, S9, K5)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tastemesh.functions.strings import join_ids, set_text
from tastemesh.functions.vectors import to_array
from tastemesh.operators import als_grams as AG
from tastemesh.operators import collaborative as CF
from tastemesh.operators import index as IX
from tastemesh.operators import social
from tastemesh.operators import sparse as SP
from tastemesh.operators import text as TX
from tastemesh.operators import wordfactors as WF
from tastemesh.plans.registry import query
from tastemesh.plans.social_queries import SOCIAL_CTES
from tastemesh.session import cut_lineage, written
from tastemesh.sources.testdata import TestTables

# --------------------------------------------------------------- indexes ---

_IDX_SQL = """
, user_index AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx
                 FROM users),
business_index AS (SELECT business_id,
                          CAST(row_number() OVER (ORDER BY business_id) - 1 AS INTEGER) AS business_idx
                   FROM business_details)"""


def _user_index(t: TestTables):
    return IX.dense_index(t.user_friends, "user_id", "user_idx")


def _business_index(t: TestTables):
    return IX.dense_index(t.business_details, "business_id", "business_idx")


@query("dense_index", views=("users", "business_details"), sql=_IDX_SQL + """
SELECT user_id, user_idx FROM user_index""")
def dense_index(spark, sf_dir):
    return IX.dense_index(TestTables(spark, sf_dir).user_friends, "user_id", "user_idx")


@query("user_with_index", views=("users", "business_details"), sql=_IDX_SQL + """
SELECT u.user_id, u.name, u.review_count, u.friends, i.user_idx
FROM users u JOIN user_index i ON u.user_id = i.user_id""")
def user_with_index(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return IX.attach_index(t.user.select("user_id", "name", "review_count", "friends"),
                           _user_index(t), "user_id")


@query("business_with_index", views=("users", "business_details"), sql=_IDX_SQL + """
SELECT b.business_id, b.name, b.city, i.business_idx
FROM business_details b JOIN business_index i ON b.business_id = i.business_id""")
def business_with_index(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return IX.attach_index(t.business_details.select("business_id", "name", "city"),
                           _business_index(t), "business_id")


@query("rating_triples", views=("users", "business_details", "review_raw"), sql=_IDX_SQL + """
SELECT u.user_idx, b.business_idx, TRY_CAST(r.stars AS FLOAT) AS rating
FROM review_raw r JOIN user_index u ON r.user_id = u.user_id
                  JOIN business_index b ON r.business_id = b.business_id""")
def rating_triples(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return IX.rating_triples(t.review_raw, _user_index(t), _business_index(t))


# ------------------------------------------------------------------ text ---

_TOKS = r"regexp_extract_all(lower(coalesce(text, '')), '\w+')"

_TERMS_SQL = f"""
, toks AS (SELECT doc_id, unnest({_TOKS}) AS term FROM documents),
kept AS (SELECT * FROM toks WHERE term NOT IN (SELECT w FROM stop_words)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM kept GROUP BY doc_id, term)"""


def _doc_tokens(t: TestTables):
    return TX.tokens(t.documents)


@query("tokenize_counts", sql=f"""
SELECT doc_id, CAST(len({_TOKS}) AS INTEGER) AS n_tokens FROM documents""")
def tokenize_counts(spark, sf_dir):
    d = TX.tokens(TestTables(spark, sf_dir).documents, stop_words=False)
    return d.select("doc_id", F.size("tokens").alias("n_tokens"))


@query("remove_stopwords_counts", views=("stop_words",), sql=f"""
, toks AS (SELECT doc_id, unnest({_TOKS}) AS term FROM documents),
kept AS (SELECT doc_id, count(*) AS n FROM toks
         WHERE term NOT IN (SELECT w FROM stop_words) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(k.n, 0) AS INTEGER) AS n_tokens
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id""")
def remove_stopwords_counts(spark, sf_dir):
    d = _doc_tokens(TestTables(spark, sf_dir))
    return d.select("doc_id", F.size("nsw").alias("n_tokens"))


@query("term_frequency", views=("stop_words",), sql=_TERMS_SQL + """
SELECT doc_id, term, tf FROM tf""")
def term_frequency(spark, sf_dir):
    return TX.term_counts(_doc_tokens(TestTables(spark, sf_dir)), "doc_id")


@query("tfidf", views=("stop_words",), sql=_TERMS_SQL + """,
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, tf.term, tf.tf,
       round(ln(((SELECT count(*) FROM documents) + 1.0) / (dfreq.df + 1.0)), 9) AS idf,
       round(tf.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (dfreq.df + 1.0)), 9) AS tfidf
FROM tf JOIN dfreq ON tf.term = dfreq.term""")
def tfidf(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    tf = TX.materialized_term_counts(_doc_tokens(t), "doc_id")
    m = t.documents.agg(F.count(F.lit(1))).scalar()
    out = TX.tfidf(tf, m, "doc_id")
    return out.select("doc_id", "term", "tf", F.round("idf", 9).alias("idf"),
                      F.round("tfidf", 9).alias("tfidf"))


@query("business_term_counts", views=("review_text", "stop_words"), sql=f"""
, toks AS (SELECT business_id, unnest({_TOKS}) AS term FROM review_text)
SELECT business_id, term, count(*) AS tf FROM toks
WHERE term NOT IN (SELECT w FROM stop_words) GROUP BY business_id, term""")
def business_term_counts(spark, sf_dir):
    return TX.business_term_counts(TestTables(spark, sf_dir).review_text)


def _fit_pipeline(t: TestTables) -> PipelineModel:
    return TX.content_pipeline().fit(TX.non_null_texts(t.documents))


@query("word2vec_vectors")
def word2vec_vectors(spark, sf_dir):
    """Six-stage pipeline fitted on the documents; word vector per document."""
    t = TestTables(spark, sf_dir)
    model = _fit_pipeline(t)
    return model.transform(TX.non_null_texts(t.documents)).select(
        "doc_id", to_array("word_vec").alias("word_vec"))


def _tfidf_norms(t: TestTables):
    tf = TX.materialized_term_counts(_doc_tokens(t), "doc_id")
    m = t.documents.agg(F.count(F.lit(1))).scalar()
    return tf, TX.tfidf_norms(TX.tfidf(tf, m, "doc_id"), "doc_id")


@query("tfidf_norms", views=("stop_words",), sql=_TERMS_SQL + """,
dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT tf.doc_id, count(*) AS n_terms,
       round(sqrt(sum((tf.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (dfreq.df + 1.0)))
                      ** 2)), 6) AS norm
FROM tf JOIN dfreq ON tf.term = dfreq.term GROUP BY tf.doc_id""")
def tfidf_norms(spark, sf_dir):
    """The TF-IDF part of the assembled vector: its terms and norm per document."""
    _, norms = _tfidf_norms(TestTables(spark, sf_dir))
    return norms.select("doc_id", "n_terms", F.round(F.sqrt("squares"), 6).alias("norm"))


_VOCABULARY_SQL = _TERMS_SQL + """,
vocabulary AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS col,
                      ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf
               FROM tf GROUP BY term)"""


def _entries(blocked, key):
    """The blocks' entries, one row each: what the oracle can compare."""
    return SP.entries(blocked, key).select(
        key, F.floor(F.col("col") / SP.BLOCK_WIDTH).cast("long").alias("block"), "col",
        F.round("value", 9).alias("value"))


@query("tfidf_blocks", views=("stop_words",), sql=_VOCABULARY_SQL + f"""
SELECT tf.doc_id, v.col // {SP.BLOCK_WIDTH} AS block, v.col, round(tf.tf * v.idf, 9) AS value
FROM tf JOIN vocabulary v ON v.term = tf.term""")
def tfidf_blocks(spark, sf_dir):
    """The TF-IDF part of every document's vector, read back from its blocks."""
    model, tf = SP.fit(TestTables(spark, sf_dir).documents)
    return _entries(SP.blocks(SP.tfidf_entries(model, tf, "doc_id"), "doc_id"), "doc_id")


@query("business_tfidf_blocks", views=("review_text", "stop_words"), sql=_VOCABULARY_SQL + f""",
btoks AS (SELECT business_id, unnest({_TOKS}) AS term FROM review_text),
btf AS (SELECT business_id, term, count(*) AS tf FROM btoks GROUP BY business_id, term)
SELECT b.business_id, v.col // {SP.BLOCK_WIDTH} AS block, v.col, round(b.tf * v.idf, 9) AS value
FROM btf b JOIN vocabulary v ON v.term = b.term""")
def business_tfidf_blocks(spark, sf_dir):
    """A model fitted on the documents, saved, loaded and applied to other documents:
    each business's texts taken together (M13, S9, K5)."""
    t = TestTables(spark, sf_dir)
    model, _ = SP.fit(t.documents, counts=False)
    path = CF.model_path(spark, "text-model")
    model.save(path)
    loaded = SP.TextModel.load(spark, path)
    return _entries(SP.transform(loaded, t.review_text, "business_id"), "business_id")


@query("content_full_vector")
def content_full_vector(spark, sf_dir):
    """The assembled TF-IDF + word vector of every document as blocks (M12): at most
    ``BLOCK_WIDTH`` entries a row, ``size`` the columns of the whole vector."""
    t = TestTables(spark, sf_dir)
    w2v = TX.word2vec_stage().fit(_doc_tokens(t))
    model, tf = SP.fit(t.documents, word_vectors=TX.word_vectors(w2v))
    return SP.transform(model, t.documents, tf=tf).withColumn("size", F.lit(model.size).cast("long"))


@query("word_factors")
def word_factors(spark, sf_dir):
    """Word vectors from co-occurrences, no vocabulary on the driver."""
    return WF.word_factors(_doc_tokens(TestTables(spark, sf_dir)))


@query("content_factor_vector")
def content_factor_vector(spark, sf_dir):
    """The assembled vector with these word vectors: every part a table."""
    t = TestTables(spark, sf_dir)
    words = written(WF.word_factors(_doc_tokens(t)))
    model, tf = SP.fit(t.documents, word_vectors=words)
    return SP.transform(model, t.documents, tf=tf).withColumn("size", F.lit(model.size).cast("long"))


@query("content_vectors_from_saved_model")
def content_vectors_from_saved_model(spark, sf_dir):
    """Fit, save, load the pipeline (K5, S9) and transform with the loaded copy."""
    t = TestTables(spark, sf_dir)
    model = _fit_pipeline(t)
    path = CF.model_path(spark, "content-pipeline")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return loaded.transform(TX.non_null_texts(t.documents)).select(
        "doc_id", to_array("word_vec").alias("word_vec"))


@query("business_word_vectors")
def business_word_vectors(spark, sf_dir):
    """Mean word vector per business over all its reviews' tokens."""
    t = TestTables(spark, sf_dir)
    w2v = TX.word2vec_stage().fit(_doc_tokens(t))
    rt = TX.tokens(t.review_text.select("business_id", "text"))
    return TX.mean_word_vectors(rt, "business_id", TX.word_vectors(w2v))


# --------------------------------------------------------- collaborative ---

def _triples(t: TestTables):
    ui, bi = _user_index(t), _business_index(t)
    # train and test parts read the triples: they are written once
    tr = cut_lineage(IX.rating_triples(t.review, ui, bi, keep=("review_id",)), required=True)
    return tr, ui, bi


def _split(t: TestTables):
    """(train, test, user index, business index) of triples without review_id."""
    ui, bi = _user_index(t), _business_index(t)
    # the split is by review_id, a long text: its outcome is carried through the joins instead
    review = t.review.withColumn("in_train", CF.in_train(["review_id"]))
    tr = written(IX.rating_triples(review, ui, bi, keep=("in_train",)))
    return *CF.train_test_split(tr, ["review_id"], label="in_train"), ui, bi


def _fit(t: TestTables):
    train, test, ui, bi = _split(t)
    return CF.fit(train), train, test, ui, bi


@query("train_test_split")
def train_test_split(spark, sf_dir):
    tr, _, _ = _triples(TestTables(spark, sf_dir))
    train, test = CF.train_test_split(tr, ["review_id"])
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@query("als_rmse")
def als_rmse(spark, sf_dir):
    model, _, test, _, _ = _fit(TestTables(spark, sf_dir))
    return CF.rmse_frame(CF.predictions(model, test))


@query("als_predictions")
def als_predictions(spark, sf_dir):
    tr, _, _ = _triples(TestTables(spark, sf_dir))
    train, test = CF.train_test_split(tr, ["review_id"])
    return CF.predictions(CF.fit(train), test)


@query("als_recommend_exploded")
def als_recommend_exploded(spark, sf_dir):
    model, *_ = _fit(TestTables(spark, sf_dir))
    return CF.recommend_exploded(model, 10)


@query("als_recs_string_ids")
def als_recs_string_ids(spark, sf_dir):
    model, _, _, ui, bi = _fit(TestTables(spark, sf_dir))
    return CF.with_string_ids(CF.recommend_exploded(model, 10), ui, bi)


@query("collaborative_recs")
def collaborative_recs(spark, sf_dir):
    model, _, _, ui, bi = _fit(TestTables(spark, sf_dir))
    return CF.ranked_lists(CF.with_string_ids(CF.recommend_exploded(model, 10), ui, bi))


def _fit_grams(t: TestTables):
    train, test, ui, bi = _split(t)
    return AG.fit(train), test, ui, bi


@query("als_gram_rmse")
def als_gram_rmse(spark, sf_dir):
    """RMSE of the factors solved from partial Gram matrices."""
    model, test, _, _ = _fit_grams(TestTables(spark, sf_dir))
    return CF.rmse_frame(model.predictions(test))


@query("als_gram_recs")
def als_gram_recs(spark, sf_dir):
    """The same factors, top 10 for all users by norm-ordered blocks, ids mapped back (M5, M6)."""
    model, _, ui, bi = _fit_grams(TestTables(spark, sf_dir))
    return CF.ranked_lists(CF.with_string_ids(model.recommend(10), ui, bi))


@query("als_from_saved_model")
def als_from_saved_model(spark, sf_dir):
    """Save the fitted model with its indexes, load both back, recommend."""
    from tastemesh.sources.models import load_als, save_als
    t = TestTables(spark, sf_dir)
    model, _, _, ui, bi = _fit(t)
    path = CF.model_path(spark, "als")
    save_als(model, ui, bi, path)
    loaded, lui, lbi = load_als(spark, path)
    return CF.with_string_ids(CF.recommend_exploded(loaded, 10), lui, lbi)


@query("collect_recs_per_user", views=("review", "l3"), sql=SOCIAL_CTES + """
SELECT user_id, string_agg(CAST(business_id AS VARCHAR), ' ' ORDER BY rank) AS business_id,
       CAST(count(*) AS INTEGER) AS n_recs,
       '[' || array_to_string(list_sort(list_distinct(list(business_id))), ', ') || ']' AS business_set
FROM s_recs GROUP BY user_id""")
def collect_recs_per_user(spark, sf_dir):
    """Per user: the ranked list of the social recommendations as text, and
    the ``collect_set`` form printed as a set (A2, X9)."""
    t = TestTables(spark, sf_dir)
    recs = social.social_pipeline(t.user_friends, t.review.select("user_id", "business_id", "stars"))
    lists = CF.ranked_lists(recs)
    sets = CF.ranked_lists(recs, as_set=True).withColumnRenamed("business_id", "_set")
    return lists.join(sets, "user_id").select(
        "user_id", join_ids("business_id", " ").alias("business_id"),
        F.size("business_id").alias("n_recs"), set_text("_set").alias("business_set"))

