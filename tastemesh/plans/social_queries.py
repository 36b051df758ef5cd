"""Social recommender queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tastemesh.operators import social
from tastemesh.plans.registry import query
from tastemesh.sources.testdata import TestTables


@query("explode_friends", views=("l1",), sql="""
SELECT user_id, friend FROM l1""")
def explode_friends(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return social.friend_edges(t.user_friends)


@query("friend_levels", views=("l1", "l2", "l3"), sql="""
SELECT user_id, friend, 3 AS weight FROM l1
UNION SELECT user_id, friend, 2 AS weight FROM l2
UNION SELECT user_id, friend, 1 AS weight FROM l3""")
def friend_levels(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return social.friend_levels(social.friend_edges(t.user_friends))


@query("friend_two_hop_sets", views=("l2",), sql="""
SELECT user_id, friend FROM l2""")
def friend_two_hop_sets(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return social.two_hop_pairs(social.friend_edges(t.user_friends))


@query("friend_adjacency", views=("l1",), sql="""
SELECT user_id, CAST(count(*) AS BIGINT) AS n_friends, min(friend) AS first_friend,
       max(friend) AS last_friend
FROM l1 GROUP BY user_id""")
def friend_adjacency(spark, sf_dir):
    """Adjacency summary per user: degree and id range (A6 without a list row)."""
    t = TestTables(spark, sf_dir)
    e = social.friend_edges(t.user_friends)
    return e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_friends"),
        F.min("friend").alias("first_friend"),
        F.max("friend").alias("last_friend"))


@query("friend_adjacency_json", views=("l2",), sql="""
SELECT CAST(to_json({'user_id': user_id, 'friend': friend}) AS VARCHAR) AS value FROM l2""")
def friend_adjacency_json(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return social.adjacency_json_lines(social.two_hop_pairs(social.friend_edges(t.user_friends)))


SOCIAL_CTES = """
, s_good AS (
  SELECT user_id AS friend, business_id, count(*) AS n
  FROM review WHERE stars >= 3 AND business_id IS NOT NULL
  GROUP BY user_id, business_id),
s_cand AS (
  SELECT p.user_id, g.business_id, sum(g.n) AS top_reviews
  FROM l3 p JOIN s_good g ON p.friend = g.friend
  GROUP BY p.user_id, g.business_id),
s_fresh AS (
  SELECT * FROM s_cand c
  WHERE NOT EXISTS (SELECT 1 FROM review r
                    WHERE r.user_id = c.user_id AND r.business_id = c.business_id)),
s_ranked AS (
  SELECT user_id, business_id, top_reviews,
         row_number() OVER (PARTITION BY user_id ORDER BY top_reviews DESC, business_id) AS rank
  FROM s_fresh),
s_recs AS (
  SELECT user_id, business_id, CAST(top_reviews AS BIGINT) AS top_reviews,
         CAST(rank AS INTEGER) AS rank
  FROM s_ranked WHERE rank <= 10)"""

SOCIAL_RECS_SQL = SOCIAL_CTES + """
SELECT * FROM s_recs"""


@query("social_recs", views=("review", "l3"), sql=SOCIAL_RECS_SQL)
def social_recs(spark, sf_dir):
    t = TestTables(spark, sf_dir)
    return social.social_pipeline(t.user_friends, t.review.select("user_id", "business_id", "stars"))


@query("social_recs_preprocessed", views=("business", "review_raw", "user_friends"), sql="""
, bf AS (
  SELECT business_id
  FROM (SELECT *, trim(unnest(string_split(categories, ','))) AS cat
        FROM business WHERE city = 'Brand#2')
  WHERE lower(cat) = 'ring'),
rf AS (SELECT * FROM review_raw WHERE business_id IN (SELECT business_id FROM bf)),
uf AS (SELECT * FROM user_friends WHERE user_id IN (SELECT user_id FROM rf)),
p1 AS (
  SELECT DISTINCT user_id, TRY_CAST(f AS BIGINT) AS friend
  FROM (SELECT user_id, trim(unnest(string_split(friends, ','))) AS f FROM uf)
  WHERE f <> 'None' AND f <> '' AND TRY_CAST(f AS BIGINT) IS NOT NULL),
p2 AS (SELECT user_id, friend FROM p1
       UNION SELECT a.user_id, b.friend FROM p1 a JOIN p1 b ON a.friend = b.user_id),
p3 AS (SELECT user_id, friend FROM p2
       UNION SELECT a.user_id, b.friend FROM p2 a JOIN p2 b ON a.friend = b.user_id),
pg AS (SELECT user_id AS friend, business_id, count(*) AS n FROM rf
       WHERE TRY_CAST(stars AS DOUBLE) >= 3 AND business_id IS NOT NULL
       GROUP BY user_id, business_id),
pc AS (SELECT p.user_id, g.business_id, sum(g.n) AS top_reviews
       FROM p3 p JOIN pg g ON p.friend = g.friend GROUP BY p.user_id, g.business_id),
pf AS (SELECT * FROM pc c WHERE NOT EXISTS (
         SELECT 1 FROM rf r WHERE r.user_id = c.user_id AND r.business_id = c.business_id)),
pr AS (SELECT user_id, business_id, top_reviews,
              row_number() OVER (PARTITION BY user_id ORDER BY top_reviews DESC, business_id) AS rank
       FROM pf)
SELECT user_id, business_id, CAST(top_reviews AS BIGINT) AS top_reviews, CAST(rank AS INTEGER) AS rank
FROM pr WHERE rank <= 10""")
def social_recs_preprocessed(spark, sf_dir):
    """The full social job: city + category cascade, then edges and levels of
    the filtered users, ranked over the filtered reviews (R5 → G1 → G2 → R1)."""
    from tastemesh.operators import preprocess as P
    from tastemesh.sources.testdata import CATEGORY_FILTER, CITY_FILTER
    t = TestTables(spark, sf_dir)
    bf = P.business_in_category(t.business, CATEGORY_FILTER, CITY_FILTER)
    rf = P.semi_join(t.review_raw.select("user_id", "business_id", "stars"), bf, "business_id")
    uf = P.semi_join(t.user_friends, rf, "user_id")
    return social.social_pipeline(uf, rf)
