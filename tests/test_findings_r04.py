"""Tests of what FINDINGS_r04 found: what jobs leave on disk, and what they score."""

import glob
import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tastemesh.operators import collaborative as CF
from tastemesh.operators import inner_product as IP
from tastemesh.operators import similarity
from tastemesh.session import cut_lineage, written


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_materialised_tables_leave_no_shuffle_files(spark):
    def grouped(n):
        return spark.range(n).groupBy((F.col("id") % 97).alias("k")).agg(F.sum("id").alias("s"))
    before = _shuffle_files(spark)
    assert written(grouped(1000)).count() == 97
    mine = cut_lineage(grouped(2000), required=True)
    for _ in range(20):
        if _shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    # the count of the written table has one of its own
    assert _shuffle_files(spark) <= before + 2
    assert mine.count() == 97
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_als_is_fitted_on_triples_without_review_id(spark, sf_small):
    from tastemesh.plans import model_queries as MQ
    from tastemesh.sources.testdata import TestTables
    train, test, _, _ = MQ._split(TestTables(spark, sf_small))
    assert train.columns == test.columns == ["user_idx", "business_idx", "rating"]
    tr, _, _ = MQ._triples(TestTables(spark, sf_small))
    parts = CF.train_test_split(tr, ["review_id"])
    for got, want in zip((train, test), parts):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.drop("review_id").collect()))
    assert CF.als().setCheckpointInterval(CF.CHECKPOINT_INTERVAL).getCheckpointInterval() < CF.MAX_ITER


def _vectors(rng, n, dim=6):
    return [(i, (rng.standard_normal(dim) + (np.arange(dim) == 0)).tolist()) for i in range(n)]


def test_rounds_of_lists_keep_only_what_is_open(spark):
    rng = np.random.default_rng(3)
    qs = spark.createDataFrame(_vectors(rng, 300), "q int, vector array<double>")
    cs = spark.createDataFrame(_vectors(rng, 500), "c int, vector array<double>")
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{root}/lists-*"))
    report = []
    got = IP.inner_product_top_k(qs, cs, 4, first_block=8, report=report).collect()
    made = set(glob.glob(f"{root}/lists-*")) - before
    assert len(made) == sum(asked > 0 for asked, _ in report) > 2
    assert len([p for p in made if glob.glob(f"{p}/open=true")]) <= 1
    assert len(got) == 1200 and len({(r.q, r["rank"]) for r in got}) == 1200


def _counted(monkeypatch):
    seen, real = [0], np.partition

    def partition(a, *args, **kw):
        seen[0] += a.size
        return real(a, *args, **kw)
    monkeypatch.setattr(np, "partition", partition)
    return seen


def test_top_lists_compare_with_the_kth_score_instead_of_ranking_tiles(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    q, c = (np.array([v for _, v in _vectors(rng, n)]) for n in (600, 6000))
    norms = np.linalg.norm(c, axis=1)
    by = np.argsort(-norms, kind="stable")
    rows = pa.table({"q": np.arange(600), "vector": pa.array(list(q)),
                     "_norm": np.linalg.norm(q, axis=1),
                     "cs": pa.array([[]] * 600, pa.list_(pa.int64())),
                     "ss": pa.array([[]] * 600, pa.list_(pa.float64()))})
    seen, chunk = _counted(monkeypatch), IP._Chunk(rows, 5)
    for lo in range(0, 6000, 1000):
        at = by[lo:lo + 1000]
        chunk.meet(at, norms[at], c[at])
    s = q @ c.T
    assert seen[0] <= 600 * 1000
    assert all(chunk.best.keys[i].tolist() == np.lexsort((np.arange(6000), -s[i]))[:5].tolist()
               for i in range(600))


def test_hybrid_reads_lists_that_are_made_one_after_the_other(spark, sf_small):
    import __spark_entry__ as E
    files = E.queries()["hybrid_recs_als"](spark, sf_small).inputFiles()
    assert files and not any("lineitem" in f for f in files)


def _frame(vectors, ids):
    return pd.DataFrame({"business_id": ids, "vector": list(vectors),
                         "_norm": np.sqrt((vectors * vectors).sum(axis=1))})


def test_cosine_blocks_rank_only_what_competes(monkeypatch):
    rng = np.random.default_rng(5)
    q, c = rng.standard_normal((300, 8)), rng.standard_normal((9000, 8))
    c[5000:5040] = c[7]                                         # equal scores: ties go by id
    seen, ids = _counted(monkeypatch), rng.permutation(9000)
    got = similarity._block_topk(6, 9, 1 << 22)(_frame(q, np.arange(300)), _frame(c, ids))
    assert seen[0] < 300 * 9000 / 3
    s = np.round((q @ c.T) / (np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)), 9)
    lists = got.sort_values(["input", "score", "business_id"], ascending=[True, False, True])
    assert all(lists[lists["input"] == i]["business_id"].tolist()
               == ids[np.lexsort((ids, -s[i]))[:6]].tolist() for i in range(300))


def test_cosine_blocks_of_odd_numbers():
    v = np.array([[1.0, 0.0], [1e-160, 0.0], [0.0, 1e160], [3.0, 4.0], [np.inf, 1.0]])
    with np.errstate(all="ignore"):
        got = similarity._block_topk(5, 9, 1 << 22)(_frame(v[:1], np.arange(1)), _frame(v, np.arange(5)))
    assert {(r.business_id, r.score) for r in got.itertuples()} >= {(0, 1.0), (3, 0.6)}


def test_line_items_are_joined_with_orders_once(spark, sf_small):
    import __spark_entry__ as E
    for name in ("recs_with_details", "hybrid_recs"):
        files = E.queries()[name](spark, sf_small).inputFiles()
        assert files and not any("lineitem" in f or "orders" in f for f in files)


def test_probes_and_coverage_of_many_rows_equal_those_of_one():
    from tastemesh.operators import lsh
    rng = np.random.default_rng(6)
    m = lsh.margins(rng.standard_normal((40, 16)), 3, 12)
    m[0, 0, 3] = m[0, 0, 4]                                     # equal costs keep their order
    depths, s = rng.integers(0, 13, (40, 3)), np.r_[rng.uniform(-1, 1, 39), 1.0]
    for probes in (1, 6):
        near, crossed, real = lsh._cheapest(m.reshape(-1, 12), depths.ravel(), probes)
        got = [[tuple(n[c].tolist()) for c, r in zip(cs, rs) if r]
               for n, cs, rs in zip(near, crossed, real)]
        assert got == [lsh.flips(m[i, t], depths[i, t], probes) for i in range(40) for t in range(3)]
        want = [lsh.coverage(m[i], depths[i], probes, s[i]) for i in range(40)]
        assert np.allclose(lsh.coverages(m, depths.ravel(), probes, s), want, atol=1e-12)


def test_a_model_alone_needs_no_counts_of_every_document(spark):
    from tastemesh.operators import sparse as SP
    once = [(1, "apple pear apple"), (2, "pear plum"), (None, None), (3, "")]
    twice = once + [(2, "pear fig"), (None, "apple apple")]
    for rows in (once, twice):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        whole, tf = SP.fit(docs)
        alone, none = SP.fit(docs, counts=False)
        assert (none is None) == (rows is once) and tf is not None
        assert sorted(map(tuple, alone.vocabulary.collect())) == sorted(map(tuple, whole.vocabulary.collect()))
        assert (alone.n_docs, alone.n_terms) == (whole.n_docs, whole.n_terms)
        # counts of batches add up: two rows of one key, null keys, terms that repeat
        got, want = (sorted(map(str, SP.entries(SP.transform(alone, docs, tf=t, width=2), "doc_id", 2)
                                .collect())) for t in (None, tf))
        assert got == want and got


def test_products_of_tiles_leave_a_task_as_whole_results(spark):
    from tastemesh.operators import wordfactors as WF
    rng = np.random.default_rng(7)
    n, tile, width = 70, 16, 3
    full = rng.random((n, n)) * (rng.random((n, n)) < 0.2)
    full = np.triu(full) + np.triu(full, 1).T
    rows = [(int(a), int(b), float(full[a, b])) for a, b in zip(*np.nonzero(full))]
    matrix = spark.createDataFrame(rows, "a long, b long, w double")
    ids = spark.range(n).select(F.col("id").alias("word"), "id")
    y = rng.standard_normal((n, width))
    block = spark.createDataFrame([(i, y[i].tolist()) for i in range(n)], "id long, v array<double>")
    tiles = written(WF._tiles(matrix, ids, tile))
    assert all(r.i <= r.j for r in tiles.select("i", "j").collect())     # one order is stored
    image = WF._times(tiles, block.select("id", WF.array_to_vector("v").alias("vector")), tile, width, n)
    got = image.collect()
    assert len(got) == len({r.id for r in got}) == int((full != 0).any(axis=1).sum())
    assert all(np.allclose(r.vector.toArray(), (full @ y)[r.id]) for r in got)
    # no sum of partial results behind the products
    assert "Aggregate" not in image._jdf.queryExecution().executedPlan().toString()


def test_tables_that_no_step_reads_any_more_are_removed(spark):
    from tastemesh.operators import wordfactors as WF
    root = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(glob.glob(f"{root}/table-*"))
    docs = spark.createDataFrame([([f"w{i % 7}", f"w{i % 5}", "x", f"w{i % 3}"],) for i in range(60)],
                                 "nsw array<string>")
    assert WF.word_factors(docs, size=3, steps=2).count() == 8
    # words, sums of rows, tiles, the last columns and their image
    assert len(set(glob.glob(f"{root}/table-*")) - before) <= 5
