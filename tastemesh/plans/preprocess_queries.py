"""Scans, lookups, filters, cascades and the topical table (S1, S2, S10, P1,
F1-F6, F9, F10, X1-X3, X11, A1, A3, A4, T1, R5-R7, J3, K2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemesh.functions.strings import split_list
from tastemesh.operators import preprocess as P
from tastemesh.operators.content import liked_items
from tastemesh.operators.topk import top_k
from tastemesh.plans.registry import query
from tastemesh.session import shared_path
from tastemesh.sources import dumps, keyed
from tastemesh.sources.lookup import lookup
from tastemesh.sources.testdata import CATEGORY_FILTER, CITY_FILTER, TestTables

BUSINESS_COLS = ["business_id", "name", "neighborhood", "address", "city", "state",
                 "postal_code", "latitude", "longitude", "stars", "review_count", "is_open",
                 "categories"]
BUSINESS_SQL_COLS = ", ".join(BUSINESS_COLS)
USER_COLS = ["user_id", "name", "review_count", "yelping_since", "friends", "useful",
             "funny", "cool", "fans", "elite"]
USER_SQL_COLS = ", ".join(USER_COLS)

# business_filter in SQL: one row per matching (trimmed) category entry
BF_SQL = f"""
, bf AS (
  SELECT {BUSINESS_SQL_COLS.replace('categories', 'cat AS categories')}
  FROM (SELECT *, trim(unnest(string_split(categories, ','))) AS cat
        FROM business WHERE city = '{CITY_FILTER}')
  WHERE lower(cat) = '{CATEGORY_FILTER}')"""

RF_SQL = BF_SQL + """,
rf AS (SELECT * FROM review_raw WHERE business_id IN (SELECT business_id FROM bf))"""


@query("scan_business", views=("business",), sql=f"SELECT {BUSINESS_SQL_COLS} FROM business")
def scan_business(spark, sf_dir):
    return TestTables(spark, sf_dir).business.select(*BUSINESS_COLS)


@query("scan_review", views=("review",), sql="SELECT * FROM review")
def scan_review(spark, sf_dir):
    return TestTables(spark, sf_dir).review


@query("dump_round_trip_review", views=("review",), sql="SELECT * FROM review")
def dump_round_trip_review(spark, sf_dir):
    """The reviews written as an extended JSON dump and read back."""
    review = TestTables(spark, sf_dir).review
    path = shared_path(spark, "review-dump")
    dumps.write_dump(review, path)
    return dumps.read_dump(spark, path, review.schema)[0]


@query("scan_user", views=("users",), sql=f"SELECT {USER_SQL_COLS} FROM users")
def scan_user(spark, sf_dir):
    return TestTables(spark, sf_dir).user.select(*USER_COLS)


@query("lookup_business_by_id", views=("business_details", "review"), sql="""
SELECT business_id, name, latitude, longitude FROM business_details
WHERE business_id IN (SELECT business_id FROM review WHERE stars = 5)""")
def lookup_business_by_id(spark, sf_dir):
    """Details of every business with a five-star review: a batch keyed lookup."""
    t = TestTables(spark, sf_dir)
    keys = t.review.filter(F.col("stars") == 5).select("business_id")
    return lookup(t.business_details, keys, "business_id").select(
        "business_id", "name", "latitude", "longitude")


@query("lookup_business_by_layout", views=("business_details", "review"), sql="""
SELECT business_id, name, latitude, longitude FROM business_details
WHERE business_id IN (SELECT business_id FROM review WHERE stars = 5)""")
def lookup_business_by_layout(spark, sf_dir):
    """The same lookup through a layout by key: only files that can hold a key are opened."""
    t = TestTables(spark, sf_dir)
    path = shared_path(spark, "business-layout")
    keyed.write_layout(t.business_details, path, "business_id")
    keys = t.review.filter(F.col("stars") == 5).select("business_id")
    return keyed.lookup(spark, path, keys, "business_id").select(
        "business_id", "name", "latitude", "longitude")


@query("lookup_business_by_name", views=("business_details",), sql=f"""
SELECT business_id, name, city FROM business_details
WHERE name IN (SELECT name FROM business_details WHERE city = '{CITY_FILTER}')""")
def lookup_business_by_name(spark, sf_dir):
    """All businesses sharing a name with any business of the filter city."""
    t = TestTables(spark, sf_dir)
    b = t.business_details
    keys = P.filter_city(b, CITY_FILTER).select("name")
    return lookup(b, keys, "name").select("business_id", "name", "city")


@query("project_review_text", views=("review_text",), sql="""
SELECT business_id, text FROM review_text""")
def project_review_text(spark, sf_dir):
    return TestTables(spark, sf_dir).review_text.select("business_id", "text")


@query("filter_business_city", views=("business",), sql=f"""
SELECT {BUSINESS_SQL_COLS} FROM business WHERE city = '{CITY_FILTER}'""")
def filter_business_city(spark, sf_dir):
    return P.filter_city(TestTables(spark, sf_dir).business, CITY_FILTER).select(*BUSINESS_COLS)


@query("split_categories", views=("business_details",), sql="""
SELECT business_id,
       array_to_string(list_transform(string_split(categories, ','), lambda x: trim(x)), '|') AS categories,
       CAST(len(string_split(categories, ',')) AS INTEGER) AS n_categories
FROM business_details""")
def split_categories(spark, sf_dir):
    b = TestTables(spark, sf_dir).business_details
    s = split_list("categories")
    return b.select("business_id", F.array_join(s, "|").alias("categories"),
                    F.size(s).alias("n_categories"))


@query("explode_categories", views=("business_details",), sql="""
SELECT business_id, trim(unnest(string_split(categories, ','))) AS category
FROM business_details""")
def explode_categories(spark, sf_dir):
    b = TestTables(spark, sf_dir).business_details.select("business_id", "categories")
    return P.explode_categories(b).select("business_id", F.col("categories").alias("category"))


@query("filter_business_category", views=("business",), sql=f"""
SELECT business_id, name, city, cat AS categories
FROM (SELECT *, trim(unnest(string_split(categories, ','))) AS cat FROM business)
WHERE lower(cat) = '{CATEGORY_FILTER}'""")
def filter_business_category(spark, sf_dir):
    b = TestTables(spark, sf_dir).business_details
    return P.business_in_category(b, CATEGORY_FILTER).select(
        "business_id", "name", "city", "categories")


@query("filter_malformed_rating", views=("review_raw",), sql="""
SELECT review_id, stars FROM review_raw WHERE stars NOT LIKE '%-%-%'""")
def filter_malformed_rating(spark, sf_dir):
    return P.drop_malformed_stars(TestTables(spark, sf_dir).review_raw).select("review_id", "stars")


@query("review_with_global_avg", views=("review_raw",), sql="""
, clean AS (SELECT * FROM review_raw WHERE stars NOT LIKE '%-%-%')
SELECT review_id, stars,
       (SELECT avg(TRY_CAST(stars AS DOUBLE)) FROM clean WHERE stars IS NOT NULL) AS avg_rating
FROM clean""")
def review_with_global_avg(spark, sf_dir):
    r = P.drop_malformed_stars(TestTables(spark, sf_dir).review_raw)
    return P.with_global_average(r).select("review_id", "stars", "avg_rating")


@query("liked_items", views=("review",), sql="""
SELECT DISTINCT user_id, business_id FROM review WHERE stars >= 3""")
def liked_items_q(spark, sf_dir):
    return liked_items(TestTables(spark, sf_dir).review)


TOP_USER_SQL = """(SELECT user_id FROM review GROUP BY user_id
                 ORDER BY count(*) DESC, user_id LIMIT 1)"""


@query("liked_items_for_user", views=("review",), sql=f"""
SELECT DISTINCT user_id, business_id FROM review
WHERE stars >= 3 AND user_id = {TOP_USER_SQL}""")
def liked_items_for_user(spark, sf_dir):
    """Liked items of one user given as a runtime value -- here the most active
    reviewer, found by a scalar subquery over the whole review table."""
    r = TestTables(spark, sf_dir).review
    top_user = (r.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
                .orderBy(F.col("n").desc(), F.col("user_id").asc()).limit(1)
                .select("user_id").scalar())
    return liked_items(r, user_id=top_user)


@query("distinct_liked_business", views=("review",), sql="""
SELECT DISTINCT business_id FROM review WHERE stars >= 3""")
def distinct_liked_business(spark, sf_dir):
    return liked_items(TestTables(spark, sf_dir).review).select("business_id").distinct()


@query("count_reviews_by_business", views=("review",), sql="""
SELECT business_id, count(*) AS top_reviews FROM review WHERE stars >= 3 GROUP BY business_id""")
def count_reviews_by_business(spark, sf_dir):
    r = TestTables(spark, sf_dir).review
    return (r.filter(F.col("stars") >= 3).groupBy("business_id")
            .agg(F.count(F.lit(1)).alias("top_reviews")))


@query("top_reviewed_business", views=("review",), sql="""
SELECT business_id, count(*) AS top_reviews FROM review WHERE stars >= 3
GROUP BY business_id ORDER BY top_reviews DESC, business_id LIMIT 10""")
def top_reviewed_business(spark, sf_dir):
    c = count_reviews_by_business(spark, sf_dir)
    return top_k(c, [F.col("top_reviews").desc(), F.col("business_id").asc()], 10)


@query("semi_review_in_business", views=("business", "review_raw"), sql=RF_SQL + """
SELECT review_id, user_id, business_id, stars FROM rf""")
def semi_review_in_business(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    bf = P.business_in_category(t.business, CATEGORY_FILTER, CITY_FILTER)
    return P.semi_join(t.review_raw, bf, "business_id").select(
        "review_id", "user_id", "business_id", "stars")


@query("semi_user_in_review", views=("business", "review_raw", "users"), sql=RF_SQL + f"""
SELECT {USER_SQL_COLS} FROM users WHERE user_id IN (SELECT user_id FROM rf)""")
def semi_user_in_review(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    bf = P.business_in_category(t.business, CATEGORY_FILTER, CITY_FILTER)
    rf = P.semi_join(t.review_raw, bf, "business_id")
    return P.semi_join(t.user, rf, "user_id").select(*USER_COLS)


@query("anti_unreviewed", views=("business_details", "review", "user_friends"), sql="""
SELECT business_id, name FROM business_details
WHERE business_id NOT IN (
  SELECT business_id FROM review
  WHERE user_id IN (SELECT user_id FROM user_friends WHERE friends = 'None'))""")
def anti_unreviewed(spark, sf_dir):
    """Businesses none of the users without friends has reviewed (NOT IN)."""
    t = TestTables(spark, sf_dir)
    lonely = t.user_friends.filter(F.col("friends") == "None")
    seen = P.semi_join(t.review, lonely, "user_id")
    return P.anti_join(t.business_details, seen, "business_id").select("business_id", "name")


@query("preprocess_business", views=("business",), sql=BF_SQL + f"""
SELECT {BUSINESS_SQL_COLS} FROM bf""")
def preprocess_business(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    bf, _, _ = P.preprocess(t.business, t.review_raw, t.user, CITY_FILTER, CATEGORY_FILTER)
    return bf.select(*BUSINESS_COLS)


@query("preprocess_review", views=("business", "review_raw"), sql=RF_SQL + """,
clean AS (SELECT * FROM rf WHERE stars NOT LIKE '%-%-%')
SELECT review_id, user_id, business_id, stars, text,
       (SELECT avg(TRY_CAST(stars AS DOUBLE)) FROM clean WHERE stars IS NOT NULL) AS avg_rating
FROM clean""")
def preprocess_review(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    _, rf, _ = P.preprocess(t.business, t.review_raw, t.user, CITY_FILTER, CATEGORY_FILTER)
    return rf


@query("preprocess_user", views=("business", "review_raw", "users"), sql=RF_SQL + f"""
SELECT {USER_SQL_COLS} FROM users WHERE user_id IN (SELECT user_id FROM rf)""")
def preprocess_user(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    _, _, uf = P.preprocess(t.business, t.review_raw, t.user, CITY_FILTER, CATEGORY_FILTER)
    return uf.select(*USER_COLS)


@query("review_context", views=("business", "review"), sql=BF_SQL + f"""
SELECT review_id, user_id, business_id, stars, text, '{CITY_FILTER}' AS city
FROM review WHERE business_id IN (SELECT business_id FROM bf)""")
def review_context(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    bf = P.business_in_category(t.business, CATEGORY_FILTER, CITY_FILTER)
    return P.review_context(t.review, bf, CITY_FILTER)


TOPICAL_SQL = f"""
, tb AS (
  SELECT business_id, stars, review_count
  FROM (SELECT *, trim(unnest(string_split(categories, ','))) AS cat FROM business)
  WHERE lower(cat) = '{CATEGORY_FILTER}'),
topical AS (
  SELECT b.business_id, b.stars AS business_stars, b.review_count AS business_review_count,
         r.review_id, r.stars AS review_stars, r.text, r.user_id, u.name,
         u.review_count AS user_review_count, u.yelping_since, u.friends, u.useful,
         u.funny, u.cool, u.fans, u.elite
  FROM tb b JOIN review r ON b.business_id = r.business_id
            JOIN users u ON r.user_id = u.user_id)"""


@query("topical_join", views=("business", "review", "users"), sql=TOPICAL_SQL + """
SELECT * FROM topical""")
def topical_join(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return P.topical_join(t.business, t.review, t.user, CATEGORY_FILTER)


@query("topical_tsv_lines", views=("business", "review", "users"), sql=TOPICAL_SQL + """
SELECT concat_ws(chr(9), """ + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in P.TOPICAL_COLUMNS) + """) AS line
FROM topical""")
def topical_tsv_lines(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return P.topical_lines(P.topical_join(t.business, t.review, t.user, CATEGORY_FILTER))
