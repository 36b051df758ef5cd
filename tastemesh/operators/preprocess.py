"""Preprocessing cascades (R5-R7): city and category filters, semi-joined
reviews and users, malformed-rating filter, global average, topical table.

All IN / NOT IN subqueries of the reference become left-semi / left-anti
joins; Catalyst turns a semi join against a small filtered side into a
broadcast at runtime (AQE) and a sort-merge join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemesh.functions.strings import split_list, tab_line
from tastemesh.operators.social import stars_value

# The column order of the tab-separated topical table (K2).
TOPICAL_COLUMNS = [
    "business_id", "business_stars", "business_review_count", "review_id", "review_stars",
    "text", "user_id", "name", "user_review_count", "yelping_since", "friends",
    "useful", "funny", "cool", "fans", "elite",
]


def filter_city(business: DataFrame, city: str) -> DataFrame:
    """``city = <value>`` (F1); pushed into the scan as an equality filter."""
    return business.filter(F.col("city") == F.lit(city))


def split_categories(business: DataFrame, trim: bool = True) -> DataFrame:
    """categories text → array<string>."""
    return business.withColumn("categories", split_list("categories", trim=trim))


def explode_categories(business: DataFrame, trim: bool = True) -> DataFrame:
    """One row per category (X2); rows with null categories disappear."""
    return business.withColumn("categories", F.explode(split_list("categories", trim=trim)))


def filter_category(exploded: DataFrame, category: str) -> DataFrame:
    """Case-insensitive ``lower(categories) = <value>``."""
    return exploded.filter(F.lower(F.col("categories")) == F.lit(category.lower()))


def business_in_category(business: DataFrame, category: str, city: str | None = None,
                         trim: bool = True) -> DataFrame:
    """The business_filter table: one row per matching category entry."""
    b = business if city is None else filter_city(business, city)
    return filter_category(explode_categories(b, trim=trim), category)


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``df.on IN (select on from keys)``."""
    return df.join(keys.select(on), on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``df.on NOT IN (select on from keys)`` on non-null keys."""
    return df.join(keys.select(on).filter(F.col(on).isNotNull()), on, "left_anti")


def drop_malformed_stars(review: DataFrame, col: str = "stars") -> DataFrame:
    """``stars NOT LIKE '%-%-%'`` (F3, X11): drops rows whose stars hold a date."""
    return review.filter(~F.col(col).cast("string").like("%-%-%"))


def with_global_average(review: DataFrame, col: str = "stars", out: str = "avg_rating") -> DataFrame:
    """Attach ``(select avg(stars) from review where stars is not null)``.

    Planned as a scalar subquery: evaluated once, then a literal in the
    projection -- no join at all.
    """
    avg = review.filter(F.col(col).isNotNull()).agg(F.avg(stars_value(review, col))).scalar()
    return review.withColumn(out, avg)


def preprocess(business: DataFrame, review: DataFrame, user: DataFrame, city: str,
               category: str, trim: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """City + category cascade (R5): (business_filter, review_filter, user_filter).

    review_filter is cleaned of malformed stars and carries ``avg_rating``.
    user_filter keeps the users with a review in the (uncleaned) filtered set,
    as the cascade in the reference does.
    """
    bf = business_in_category(business, category, city, trim)
    return (bf, *cascade(bf, review, user))


def cascade(business_filter: DataFrame, review: DataFrame,
            user: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(review_filter, user_filter) of already filtered businesses."""
    rf = semi_join(review, business_filter, "business_id")
    return with_global_average(drop_malformed_stars(rf)), semi_join(user, rf, "user_id")


def review_context(review: DataFrame, business_filter: DataFrame, city: str) -> DataFrame:
    """Reviews of the filtered businesses with the business city attached."""
    return semi_join(review, business_filter, "business_id").withColumn("city", F.lit(city))


def topical_join(business: DataFrame, review: DataFrame, user: DataFrame,
                 category: str, trim: bool = True) -> DataFrame:
    """business_filter (any city) ⋈ review ⋈ user → 16 topical columns."""
    bf = filter_category(explode_categories(
        business.select("business_id", "stars", "review_count", "categories"), trim), category)
    b = bf.select("business_id", F.col("stars").alias("business_stars"),
                  F.col("review_count").alias("business_review_count"))
    r = review.select("business_id", "review_id", F.col("stars").alias("review_stars"),
                      "text", "user_id")
    u = user.select("user_id", "name", F.col("review_count").alias("user_review_count"),
                    "yelping_since", "friends", "useful", "funny", "cool", "fans", "elite")
    return b.join(r, "business_id").join(u, "user_id").select(*TOPICAL_COLUMNS)


def topical_lines(topical: DataFrame) -> DataFrame:
    """One tab-separated text line per topical row (K2), nulls printed as ``null``."""
    return topical.select(tab_line(*TOPICAL_COLUMNS).alias("line"))
