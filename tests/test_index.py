from pyspark.sql import functions as F

from tastemesh.operators import index as IX


def test_dense_index_contiguous_in_key_order(spark):
    keys = [f"k{i:05d}" for i in range(997)] * 2 + [None]
    df = spark.createDataFrame([(k,) for k in keys], "user_id string").repartition(7)
    idx = IX.dense_index(df, "user_id", "user_idx", num_partitions=5)
    got = sorted((r.user_id, r.user_idx) for r in idx.collect())
    assert [i for _, i in got] == list(range(997))
    assert [k for k, _ in got] == sorted(set(k for k in keys if k))
    assert dict(idx.dtypes)["user_idx"] == "int"


def test_rating_triples_try_cast(spark):
    r = spark.createDataFrame([("u", "b", "4.0"), ("u", "c", "2018-01-02")],
                              "user_id string, business_id string, stars string")
    ui = spark.createDataFrame([("u", 0)], "user_id string, user_idx int")
    bi = spark.createDataFrame([("b", 0), ("c", 1)], "business_id string, business_idx int")
    out = sorted(tuple(x) for x in IX.rating_triples(r, ui, bi).collect())
    assert out == [(0, 0, 4.0), (0, 1, None)]
