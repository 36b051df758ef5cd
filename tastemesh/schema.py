"""Logical schemas of the three input collections and of the result tables.

Column names follow the collections the recommenders read (``business``,
``review``, ``user``).  Id columns are typed by the caller's data: the
library works with string ids as well as integer ids, so the schemas below are
the *document* form (string ids); loaders over other sources may use longs.
"""

from pyspark.sql import types as T

BUSINESS = T.StructType([
    T.StructField("business_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("neighborhood", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postal_code", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("stars", T.DoubleType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("is_open", T.IntegerType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("categories", T.StringType()),
    T.StructField("hours", T.MapType(T.StringType(), T.StringType())),
])

REVIEW = T.StructType([
    T.StructField("review_id", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("business_id", T.StringType()),
    # stars stays text-capable: source collections may carry shifted columns
    # (a date in the stars field); numeric use goes through try_cast.
    T.StructField("stars", T.StringType()),
    T.StructField("text", T.StringType()),
])

USER = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("name", T.StringType()),
    T.StructField("review_count", T.LongType()),
    T.StructField("yelping_since", T.StringType()),
    T.StructField("friends", T.StringType()),
    T.StructField("useful", T.IntegerType()),
    T.StructField("funny", T.IntegerType()),
    T.StructField("cool", T.IntegerType()),
    T.StructField("fans", T.IntegerType()),
    T.StructField("elite", T.StringType()),
])

SCHEMAS = {"business": BUSINESS, "review": REVIEW, "user": USER}

# Result schemas (documentation; operators produce these column sets).
SOCIAL_RECS_COLUMNS = ["user_id", "business_id", "top_reviews", "rank"]
CONTENT_RECS_COLUMNS = ["user_id", "business_id", "score", "rank"]
HYBRID_COLUMNS = ["user_id", "type", "rank", "business_id", "name", "latitude", "longitude"]
EDGE_COLUMNS = ["user_id", "friend", "weight"]
