"""The driver's TPC-H-ish parquet tables mapped onto business / review / user.

Mapping (see FIXTURES.md §3):

* review  = lineitem ⋈ orders: user_id = o_custkey, business_id = l_partkey,
  stars = 1 + (int(l_quantity) - 1) % 5, review_id = orderkey-linenumber-partkey-suppkey
* review_raw: same rows with stars as text, every 50th part id shifted to a date
* user    = customer: user_id = c_custkey, name = c_name, friends from a rule
* business = part: city = p_brand, categories = "p_type, word, word", stars and
  review_count aggregated over review
* review_text = documents: review_id = doc_id, business_id = doc_id % (parts div 10)
* item_vectors = embeddings ⋈ business ids, vector cast to double

Every table is a lazy DataFrame over the parquet files, so Catalyst prunes the
columns and pushes the filters of each query down to the scans.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.session import written

# Fixed values of the test mapping (FIXTURES.md §3).
NO_FRIENDS_MARKER = "None"
MALFORMED_STARS = "2018-01-02"
CITY_FILTER = "Brand#2"
CATEGORY_FILTER = "ring"


class TestTables:
    """Lazy logical tables over one scale-factor directory."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw_texts(self) -> DataFrame:
        """The documents as they are stored.

        Only where they come in fewer files than the session has shuffle partitions
        (the test data is one row group, which one task reads) are the texts dealt
        out, row by row and by no key, so neither null nor equal ids meet in a task.
        """
        d = self.raw("documents").select("doc_id", "text")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return d if len(d.inputFiles()) >= n else d.repartition(n)

    # -- review -----------------------------------------------------------
    def _review_rows(self) -> DataFrame:
        li = self.raw("lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        od = self.raw("orders").select("o_orderkey", "o_custkey")
        return li.join(od, li.l_orderkey == od.o_orderkey)

    @cached_property
    def review(self) -> DataFrame:
        r = self._review_rows()
        return r.select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            .alias("review_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("business_id"),
            (F.lit(1) + (F.col("l_quantity").cast("int") - 1) % 5).cast("double").alias("stars"),
            F.lit(None).cast("string").alias("text"),
        )

    def share_reviews(self) -> "TestTables":
        """From now on ``review`` is (user_id, business_id, stars), written once: for queries
        that read it several times, each of which would join line items and orders anew."""
        self.review = written(self.review.select("user_id", "business_id", "stars"))
        return self

    @cached_property
    def review_raw(self) -> DataFrame:
        """Reviews whose stars are text, some shifted to a date (malformed)."""
        r = self.review
        return r.withColumn(
            "stars",
            F.when(F.col("business_id") % 50 == 0, F.lit(MALFORMED_STARS))
            .otherwise(F.col("stars").cast("string")))

    # -- user -------------------------------------------------------------
    @cached_property
    def user(self) -> DataFrame:
        cust = self.raw("customer").select("c_custkey", "c_name")
        n = cust.agg(F.count(F.lit(1))).scalar()
        k = F.col("c_custkey")
        friends = F.when(k % 10 == 9, F.lit(NO_FRIENDS_MARKER)).otherwise(
            F.concat(((k * 3 + 1) % n).cast("string"), F.lit(", "),
                     ((k * 7 + 5) % n).cast("string")))
        counts = self.review.groupBy("user_id").agg(F.count(F.lit(1)).alias("review_count"))
        base = cust.select(k.alias("user_id"), F.col("c_name").alias("name"), friends.alias("friends"))
        return base.join(counts, "user_id", "left").select(
            "user_id", "name",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            F.lit(None).cast("string").alias("yelping_since"),
            "friends",
            F.lit(0).alias("useful"), F.lit(0).alias("funny"), F.lit(0).alias("cool"),
            F.lit(0).alias("fans"),
            F.lit(None).cast("string").alias("elite"),
        )

    @cached_property
    def user_friends(self) -> DataFrame:
        """(user_id, friends) only -- no review aggregate in the plan."""
        cust = self.raw("customer").select("c_custkey")
        n = cust.agg(F.count(F.lit(1))).scalar()
        k = F.col("c_custkey")
        friends = F.when(k % 10 == 9, F.lit(NO_FRIENDS_MARKER)).otherwise(
            F.concat(((k * 3 + 1) % n).cast("string"), F.lit(", "),
                     ((k * 7 + 5) % n).cast("string")))
        return cust.select(k.alias("user_id"), friends.alias("friends"))

    # -- business ---------------------------------------------------------
    def _business_base(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            F.col("p_partkey").alias("business_id"),
            F.col("p_name").alias("name"),
            F.lit(None).cast("string").alias("neighborhood"),
            F.lit(None).cast("string").alias("address"),
            F.col("p_brand").alias("city"),
            F.lit(None).cast("string").alias("state"),
            F.lit(None).cast("string").alias("postal_code"),
            (F.col("p_size") / F.lit(1.0)).alias("latitude"),
            (F.col("p_retailprice") / F.lit(100.0)).alias("longitude"),
            F.lit(1).alias("is_open"),
            F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("attributes"),
            F.concat(F.col("p_type"), F.lit(", "),
                     F.regexp_replace("p_name", " ", ", ")).alias("categories"),
            F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("hours"),
        )

    @cached_property
    def business(self) -> DataFrame:
        agg = self.review.groupBy("business_id").agg(
            F.avg("stars").alias("stars"), F.count(F.lit(1)).alias("review_count"))
        b = self._business_base().join(agg, "business_id", "left")
        return b.select(
            "business_id", "name", "neighborhood", "address", "city", "state",
            "postal_code", "latitude", "longitude", "stars",
            F.coalesce("review_count", F.lit(0)).alias("review_count"),
            "is_open", "attributes", "categories", "hours")

    @cached_property
    def business_details(self) -> DataFrame:
        """Business columns without the review aggregate (cheap lookups)."""
        return self._business_base()

    # -- text and vectors -------------------------------------------------
    @cached_property
    def review_text(self) -> DataFrame:
        n_parts = self.raw("part").agg(F.count(F.lit(1))).scalar()
        d = self.raw_texts()
        return d.select(
            F.col("doc_id").alias("review_id"),
            (F.col("doc_id") % F.floor(n_parts / F.lit(10))).alias("business_id"),
            F.col("text"))

    @cached_property
    def documents(self) -> DataFrame:
        return self.raw_texts()

    @cached_property
    def item_vectors(self) -> DataFrame:
        e = self.raw("embeddings").select(
            F.col("vec_id").alias("business_id"),
            F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
        ids = self.raw("part").select(F.col("p_partkey").alias("business_id"))
        return e.join(ids, "business_id", "left_semi")
