"""Hash index neighbours (J7) against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemesh.operators import lsh
from tastemesh.operators.similarity import cosine_top_k
from tastemesh.plans import QUERIES
from tastemesh.sources.testdata import TestTables


def recall(got, want):
    g = {(r.input, r.business_id) for r in got}
    return len(g & {(r.input, r.business_id) for r in want}) / len(want)


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)],
                                 "business_id long, vector array<double>").repartition(4)


def test_recall_on_vectors_without_structure(spark):
    """Far neighbours fail the check and come from the exact search."""
    iv = TestTables(spark, "/root/testdata/sf0.01").item_vectors.cache()
    parts = {}
    got = lsh.cosine_top_k_lsh(iv, 10, 9, leaf_rows=40, parts=parts).collect()
    want = cosine_top_k(iv, iv, 10, digits=9).collect()
    assert len(got) == len(want) and recall(got, want) >= 0.9
    assert len(parts["index"].levels) > 1 and parts["rest"].count() > 0


def test_near_neighbours_come_from_buckets(spark):
    """Clusters, with a third of the rows one vector and a dense group in one bucket."""
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((100, 16)), 20, axis=0)
    x += 0.1 * rng.standard_normal(x.shape)
    x[:700] = x[0]
    x[700:1000] = x[700] + 1e-9 * rng.standard_normal((300, 16))
    df, parts = frame(spark, x).cache(), {}
    got = lsh.cosine_top_k_lsh(df, 10, leaf_rows=40, bits=20, parts=parts).collect()
    want = cosine_top_k(df, df, 10, digits=6).collect()
    best = {(r.input, r["rank"]): r.score for r in want}
    assert len(got) == len(want)
    # of near-equal scores any order will do: the scores must agree
    close = sum(abs(best[r.input, r["rank"]] - r.score) < 1e-5 for r in got)
    assert close / len(want) >= 0.9
    assert parts["rest"].count() < 200
    index = parts["index"]
    assert index.leaves.agg(F.max("depth")).first()[0] == 20       # the dense group, dealt in chunks
    sizes = index.members.groupBy("t", "depth", "prefix", "chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 80
    assert index.members.count() == 8 * parts["asked"][0][0].count()
    assert lsh.scored_pairs(parts) < 0.8 * 1301 ** 2 * 8


def test_copies_rank_by_id(spark):
    x = np.array([[1.0, 0.0]] * 6 + [[0.0, 1.0]] + [[0.0, 0.0]])
    df = frame(spark, x, ids=[9, 3, 5, 7, 1, 8, 2, 4]).union(
        spark.createDataFrame([(None, [1.0, 0.0]), (20, None)], "business_id long, vector array<double>"))
    got = {}
    for r in lsh.cosine_top_k_lsh(df, 3).collect():
        got.setdefault(r.input, []).append((r["rank"], r.business_id))
    assert {i: [b for _, b in sorted(v)] for i, v in got.items()} == {
        9: [1, 3, 5], 3: [1, 5, 7], 5: [1, 3, 7], 7: [1, 3, 5], 1: [3, 5, 7], 8: [1, 3, 5],
        2: [1, 3, 5]}


@pytest.mark.parametrize("s", [0.3, 0.7, 0.95])
def test_coverage_is_the_chance_to_be_found(s):
    """The estimate against simulated neighbours at cosine s."""
    rng = np.random.default_rng(3)
    q = rng.standard_normal(64)
    q /= np.linalg.norm(q)
    z = rng.standard_normal((4000, 64))
    z -= np.outer(z @ q, q)
    near = s * q + np.sqrt(1 - s * s) * z / np.linalg.norm(z, axis=1, keepdims=True)
    tables, bits, depth, probes = 4, 20, 8, 5
    m = lsh.margins(q[None, :], tables, bits)[0]
    own, codes = lsh.codes_of(m[None])[0], lsh.codes_of(lsh.margins(near, tables, bits))
    hit = np.zeros(len(near), bool)
    for t in range(tables):
        for c in lsh.flips(m[t], depth, probes):
            code = int(own[t]) ^ sum(1 << (bits - 1 - j) for j in c)
            hit |= codes[:, t] >> (bits - depth) == code >> (bits - depth)
    assert abs(hit.mean() - lsh.coverage(m, [depth] * tables, probes, s)) < 0.12


def test_lsh_query_runs(spark, sf_small):
    n = TestTables(spark, sf_small).item_vectors.count()
    assert QUERIES["item_cosine_topk_lsh"](spark, sf_small).count() == 10 * n
