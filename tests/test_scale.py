"""Plan-shape tests: the properties the cluster-scale design relies on."""

import contextlib

from pyspark.sql import functions as F

import __spark_entry__ as E
from tastemesh.operators import social


def _plan(spark, df, mode="FORMATTED"):
    df.createOrReplaceTempView("_plan_probe")
    return spark.sql(f"EXPLAIN {mode} SELECT * FROM _plan_probe").collect()[0][0]


@contextlib.contextmanager
def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_city_filter_and_pruning_reach_the_scan(spark, sf_small):
    plan = _plan(spark, E.queries()["filter_business_city"](spark, sf_small))
    assert "EqualTo(p_brand,Brand#2)" in plan
    # lineitem is read for the review aggregate, but only the needed columns
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_social_plan_is_jvm_only_with_partial_group_limit(spark, sf_small):
    plan = _plan(spark, E.queries()["social_recs"](spark, sf_small))
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_hot_friend_join_is_split_by_aqe(spark, capsys):
    # one celebrity friend of every user, who reviewed many businesses
    n_users, n_biz = 400, 300
    users = spark.range(1, n_users).select(
        F.col("id").alias("user_id"),
        F.concat(F.lit("0, "), ((F.col("id") % 97) + 1).cast("string")).alias("friends"))
    hot = spark.range(n_biz).select(F.lit(0).cast("long").alias("user_id"),
                                    F.col("id").alias("business_id"), F.lit(5.0).alias("stars"))
    cold = spark.range(1, n_users).select("id").select(
        F.col("id").alias("user_id"), (F.col("id") % 7 + n_biz).alias("business_id"),
        F.lit(4.0).alias("stars"))
    reviews = hot.unionByName(cold)
    with _conf(spark, **{
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        edges = social.friend_edges(users)
        df = social.social_recommendations(reviews, edges, k=10)
        got = sorted(tuple(r) for r in df.collect())
        capsys.readouterr()
        df.explain()
        final_plan = capsys.readouterr().out
    assert "isFinalPlan=true" in final_plan and "skew=true" in final_plan
    with _conf(spark, **{"spark.sql.adaptive.skewJoin.enabled": "false"}):
        plain = sorted(tuple(r) for r in social.social_recommendations(reviews, edges, k=10).collect())
    assert got == plain and len(got) == (n_users - 1) * 10


def test_tfidf_plans_without_hints_and_without_a_cap(spark):
    from tastemesh.operators import text as TX
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 11} common") for i in range(200)],
                                 "doc_id long, text string")
    tf = TX.term_counts(TX.tokens(docs), "doc_id")
    with _conf(spark, **{"spark.sql.adaptive.enabled": "false",
                         "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        whole = _plan(spark, TX.tfidf(tf, F.lit(200), "doc_id"))
        capped = _plan(spark, TX.tfidf(tf, F.lit(200), "doc_id", vocab_size=5))
    assert "TakeOrderedAndProject" not in whole and "TakeOrderedAndProject" not in capped
    assert "BroadcastHashJoin" not in whole        # no hint: the size decides
    assert "rangepartitioning" not in whole        # no global sort where nothing is cut
    assert len(TX.tfidf(tf, F.lit(200), "doc_id").select("term").distinct().collect()) == 12


def test_als_is_independent_of_the_core_count(spark):
    """The same blocks whatever the session's parallelism: equal recommendations from
    differently partitioned input."""
    from tastemesh.operators import collaborative as CF
    rows = [(u, (u * 7 + i * 3) % 25, float((u + i) % 5 + 1)) for u in range(40) for i in range(8)]
    df = spark.createDataFrame(rows, "user_idx int, business_idx int, rating float")
    assert CF.als(num_blocks=CF.NUM_BLOCKS).getNumUserBlocks() == 10

    def recs(n):
        model = CF.fit(df.repartition(n, "user_idx").sortWithinPartitions("user_idx", "business_idx"))
        return {(r.user_idx, r.business_idx) for r in CF.recommend_exploded(model, 5).collect()}
    assert recs(2) == recs(16)
