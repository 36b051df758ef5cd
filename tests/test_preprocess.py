from tastemesh.operators import preprocess as P
from helpers import rows


def _business(spark):
    return spark.createDataFrame(
        [("b1", "Las Vegas", "Food, Restaurants"), ("b2", "Las Vegas", "Restaurants"),
         ("b3", "Las Vegas", "restaurants,Bars"), ("b4", "Las Vegas", None),
         ("b5", "Las Vegas", ""), ("b6", "Reno", "Restaurants")],
        "business_id string, city string, categories string")


def test_category_filter_trims_and_ignores_case(spark):
    bf = P.business_in_category(_business(spark), "restaurants", city="Las Vegas")
    assert rows(bf, "business_id") == [("b1",), ("b2",), ("b3",)]


def test_literal_split_misses_leading_space(spark):
    bf = P.business_in_category(_business(spark), "restaurants", city="Las Vegas", trim=False)
    assert rows(bf, "business_id") == [("b2",), ("b3",)]


def test_explode_drops_null_keeps_empty(spark):
    ex = P.explode_categories(_business(spark))
    ids = [r[0] for r in rows(ex, "business_id")]
    assert "b4" not in ids and "b5" in ids


def test_malformed_ratings_and_global_average(spark):
    r = spark.createDataFrame([("r1", "3.0"), ("r2", "2.9"), ("r3", None), ("r4", "2018-01-02")],
                              "review_id string, stars string")
    clean = P.drop_malformed_stars(r)
    assert rows(clean, "review_id") == [("r1",), ("r2",)]
    avg = P.with_global_average(clean).collect()
    assert all(abs(x.avg_rating - 2.95) < 1e-12 for x in avg)


def test_cascade_semi_joins(spark):
    b = _business(spark)
    rv = spark.createDataFrame(
        [("r1", "u1", "b1", "4.0", "t"), ("r2", "u2", "b6", "5.0", "t"),
         ("r3", "u3", "b2", "2018-01-02", "t")],
        "review_id string, user_id string, business_id string, stars string, text string")
    us = spark.createDataFrame([("u1", "x"), ("u2", "y"), ("u3", "z"), ("u4", "w")],
                               "user_id string, name string")
    bf, rf, uf = P.preprocess(b, rv, us, "Las Vegas", "restaurants")
    assert rows(rf, "review_id") == [("r1",)]
    assert rows(uf, "user_id") == [("u1",), ("u3",)]  # users of the uncleaned filtered reviews
    ctx = P.review_context(rv, bf, "Las Vegas")
    assert rows(ctx, "review_id", "city") == [("r1", "Las Vegas"), ("r3", "Las Vegas")]


def test_anti_join_ignores_null_keys(spark):
    a = spark.createDataFrame([("x",), ("y",)], "business_id string")
    keys = spark.createDataFrame([("x",), (None,)], "business_id string")
    assert rows(P.anti_join(a, keys, "business_id")) == [("y",)]


def test_topical_lines_print_null(spark):
    df = spark.createDataFrame([tuple([None] * 16)], ", ".join(
        f"{c} string" for c in P.TOPICAL_COLUMNS))
    line = P.topical_lines(df).collect()[0].line
    assert line == "\t".join(["null"] * 16)


def test_set_text_and_id_lists(spark):
    from pyspark.sql import functions as F
    from tastemesh.functions.strings import field_of_line, join_ids, parse_id_list, set_text
    df = spark.createDataFrame([(["b", "a", "b"], "u1,3 1 2 ")], "s array<string>, line string")
    r = df.select(set_text("s").alias("t"), field_of_line("line", 0).alias("u"),
                  parse_id_list(field_of_line("line", 1)).alias("ids"),
                  join_ids(F.array(F.lit(3), F.lit(1))).alias("j")).collect()[0]
    assert (r.t, r.u, r.ids, r.j) == ("[a, b]", "u1", ["3", "1", "2"], "3 1")
