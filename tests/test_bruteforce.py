"""Spark operators against plain-Python implementations on random fixtures."""

import math
import random

import pytest

from tastemesh.operators import content as C
from tastemesh.operators import social
from tastemesh.functions.vectors import cosine


def _py_levels(adj, levels=3):
    cur = {u: set(fs) for u, fs in adj.items()}
    for _ in range(levels - 1):
        nxt = {}
        for u, fs in cur.items():
            s = set(fs)
            for f in fs:
                s |= cur.get(f, set())
            nxt[u] = s
        cur = nxt
    return cur


def _py_social(users, reviews, k=10):
    adj = {}
    for u, friends in users:
        if friends is None or friends == "None":
            continue
        for f in friends.split(","):
            f = f.strip()
            if f and f != "None":
                adj.setdefault(u, set()).add(f)
    l3 = _py_levels(adj)
    out = []
    for u, fs in l3.items():
        own = {b for ru, b, _ in reviews if ru == u}
        cnt = {}
        for ru, b, s in reviews:
            if ru in fs and s >= 3 and b not in own:
                cnt[b] = cnt.get(b, 0) + 1
        ranked = sorted(cnt.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(u, b, c, i + 1) for i, (b, c) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_social_equals_python(spark, seed):
    rnd = random.Random(seed)
    n = 30
    users = []
    for i in range(n):
        if rnd.random() < 0.15:
            users.append((f"u{i:02d}", "None"))
        else:
            fr = {f"u{rnd.randrange(n + 3):02d}" for _ in range(rnd.randint(1, 3))}
            users.append((f"u{i:02d}", ", ".join(sorted(fr))))
    reviews = [(f"u{rnd.randrange(n):02d}", f"b{rnd.randrange(15):02d}", float(rnd.randint(1, 5)))
               for _ in range(150)]
    u_df = spark.createDataFrame(users, "user_id string, friends string")
    r_df = spark.createDataFrame(reviews, "user_id string, business_id string, stars double")
    got = sorted(tuple(r) for r in social.social_pipeline(u_df, r_df, k=4)
                 .select("user_id", "business_id", "top_reviews", "rank").collect())
    assert got == _py_social(users, reviews, k=4)


def _py_content(reviews, vecs, k, nb):
    def cos(a, b):
        na, nb_ = math.sqrt(sum(x * x for x in a)), math.sqrt(sum(x * x for x in b))
        return None if na == 0 or nb_ == 0 else round(sum(x * y for x, y in zip(a, b)) / (na * nb_), 9)
    liked = {}
    for u, b, s in reviews:
        if s >= 3:
            liked.setdefault(u, set()).add(b)
    neigh = {}
    for i, a in vecs.items():
        sc = [(cos(a, v), j) for j, v in vecs.items() if j != i]
        sc = [(s, j) for s, j in sc if s is not None]
        if cos(a, a) is None:
            continue
        neigh[i] = sorted(sc, key=lambda x: (-x[0], x[1]))[:nb]
    out = []
    for u, items in liked.items():
        best = {}
        for i in items:
            for s, j in neigh.get(i, []):
                if j not in items:
                    best[j] = max(best.get(j, -2.0), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(u, j, s, r + 1) for r, (j, s) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("seed", [4, 5])
def test_content_equals_python(spark, seed):
    rnd = random.Random(seed)
    vecs = {i: [float(rnd.randint(-2, 2)) for _ in range(3)] for i in range(25)}
    reviews = [(f"u{rnd.randrange(12)}", rnd.randrange(30), float(rnd.randint(1, 5)))
               for _ in range(80)]
    r_df = spark.createDataFrame(reviews, "user_id string, business_id long, stars double")
    b_df = spark.createDataFrame([(i,) for i in range(30)], "business_id long")
    v_df = spark.createDataFrame(list(vecs.items()), "business_id long, vector array<double>")
    got = C.content_recommendations(r_df, b_df, v_df, k=3, neighbours=4, block_size=8, digits=9)
    got = sorted((r.user_id, r.business_id, round(r.score, 9), r.rank) for r in got.collect())
    assert got == _py_content(reviews, vecs, k=3, nb=4)


def test_cosine_symmetric_and_bounded(spark):
    rnd = random.Random(9)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(5)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    b = df.withColumnRenamed("id", "id2").withColumnRenamed("v", "w")
    s = {(r.id, r.id2): r.s for r in df.join(b, df.id < b.id2 + 100).select(
        "id", "id2", cosine("v", "w").alias("s")).collect()}
    for (i, j), v in s.items():
        assert -1 - 1e-12 <= v <= 1 + 1e-12
        assert abs(v - s[(j, i)]) < 1e-12
