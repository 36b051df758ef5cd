from pyspark.sql import functions as F

from tastemesh.operators import social
from helpers import rows

SEVEN = [("ab", "cd"), ("cd", "de"), ("bc", "bcd"), ("bc", "cad"), ("cad", "cade"),
         ("ab", "cfgd"), ("cfgd", "cfgde")]


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "user_id string, friend string")


def test_two_hop_sets_of_seven_edge_graph(spark):
    out = social.two_hop_pairs(_edges(spark, SEVEN))
    got = {}
    for u, f in rows(out):
        got.setdefault(u, set()).add(f)
    assert got == {"ab": {"cd", "cfgd", "de", "cfgde"}, "bc": {"bcd", "cad", "cade"},
                   "cd": {"de"}, "cad": {"cade"}, "cfgd": {"cfgde"}}


def test_level_three_reaches_four_hops(spark):
    chain = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("e", "f")]
    l1, l2, l3 = social.level_sets(_edges(spark, chain), 3)
    a3 = {f for u, f in rows(l3) if u == "a"}
    assert a3 == {"b", "c", "d", "e"}
    assert {f for u, f in rows(l2) if u == "a"} == {"b", "c"}
    # L1 ⊆ L2 ⊆ L3
    s1, s2, s3 = set(rows(l1)), set(rows(l2)), set(rows(l3))
    assert s1 <= s2 <= s3


def test_friend_levels_weights(spark):
    lv = social.friend_levels(_edges(spark, [("a", "b"), ("b", "c")]))
    assert rows(lv) == [("a", "b", 1), ("a", "b", 2), ("a", "b", 3),
                        ("a", "c", 1), ("a", "c", 2), ("b", "c", 1), ("b", "c", 2), ("b", "c", 3)]


def test_friend_edges_parsing(spark):
    users = spark.createDataFrame(
        [("u1", "u2, u3"), ("u2", "None"), ("u3", "u3"), ("u4", "zz, "), ("u5", None), ("u6", "")],
        "user_id string, friends string")
    assert rows(social.friend_edges(users)) == [("u1", "u2"), ("u1", "u3"), ("u3", "u3"),
                                                ("u4", "zz")]
    # literal split keeps the leading space
    assert ("u1", " u3") in rows(social.friend_edges(users, trim=False))


def test_friend_edges_long_ids_drop_garbage(spark):
    users = spark.createDataFrame([(1, "2, x, 3"), (2, "None")], "user_id long, friends string")
    assert rows(social.friend_edges(users)) == [(1, 2), (1, 3)]


def test_social_recommendations(spark):
    users = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("c", "None"), ("d", "a, ghost"), ("e", "e")],
        "user_id string, friends string")
    reviews = spark.createDataFrame(
        [("b", "x", 5.0), ("b", "y", 3.0), ("c", "y", 4.0), ("c", "z", 2.0),
         ("a", "y", 1.0), ("b", "w", 3.0), ("c", "w", 3.0), ("e", "q", 5.0)],
        "user_id string, business_id string, stars double")
    out = social.social_pipeline(users, reviews, k=2)
    got = rows(out, "user_id", "business_id", "top_reviews", "rank")
    # a: friends b, c (levels); y already reviewed by a → excluded; w (2) before x (1)
    assert [r for r in got if r[0] == "a"] == [("a", "w", 2, 1), ("a", "x", 1, 2)]
    # b: friend c; c's good reviews y, w; b reviewed both → none left
    assert [r for r in got if r[0] == "b"] == []
    # d: friend a (and unknown ghost); reaches b and c; a's own y not good
    assert [r for r in got if r[0] == "d"] == [("d", "w", 2, 1), ("d", "y", 2, 2)]
    # e: only itself; its own reviews are excluded
    assert [r for r in got if r[0] == "e"] == []
    # nothing recommended is already reviewed by the user
    seen = set(rows(reviews.select("user_id", "business_id")))
    assert not any((u, b) in seen for u, b, _, _ in got)


def test_social_ties_by_business_id(spark):
    users = spark.createDataFrame([("a", "b")], "user_id string, friends string")
    reviews = spark.createDataFrame([("b", "z", 4.0), ("b", "m", 4.0), ("b", "k", 4.0)],
                                    "user_id string, business_id string, stars double")
    got = rows(social.social_pipeline(users, reviews, k=2), "business_id", "rank")
    assert got == [("k", 1), ("m", 2)]


def test_adjacency_json_lines(spark):
    out = social.adjacency_json_lines(_edges(spark, [("a", "b")]))
    assert [r.value for r in out.collect()] == ['{"user_id":"a","friend":"b"}']


def test_lists_and_slices_give_the_same_sums(spark, monkeypatch):
    """Short lists, cut users and small batches against sums by hand; whole lists are shuffled."""
    monkeypatch.setattr(social, "LIST_ROWS", 3)
    monkeypatch.setattr(social, "SLICE_PAIRS", 4)
    reviews = [(u, (u * 7 + j * j) % 23, float(1 + (u + j) % 5)) for u in range(20) for j in range(12)]
    reviews += [(3, None, 5.0), (None, 4, 5.0), (4, 1, None)]
    pairs = [(u, f) for u in range(20) for f in range(20) if u == 0 or (u + f) % 9 == 0]
    pairs += [(None, 3), (77, 5), (6, None), (0, 3)]
    sums = {}
    for u, f in set(pairs):
        for r, b, stars in reviews:
            if r is not None and r == f and b is not None and (stars or 0) >= 3:
                sums.setdefault(u, {}).setdefault(b, 0)
                sums[u][b] += 1
    own = {(u, b) for u, b, _ in reviews if u is not None}
    want = set()
    for u, found in sums.items():
        best = sorted((-n, b) for b, n in found.items() if (u, b) not in own)[:4]
        want |= {(u, b, -n, i + 1) for i, (n, b) in enumerate(best)}
    r = spark.createDataFrame(reviews, "user_id long, business_id long, stars double").repartition(4)
    p = spark.createDataFrame(pairs, "user_id long, friend long").repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = social.social_recommendations(r, p, k=4)
        got = {(x.user_id, x.business_id, x.top_reviews, x["rank"]) for x in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and any(
        "REPARTITION_BY_COL" in x and "_slice" in x for x in plan.split("\n"))
