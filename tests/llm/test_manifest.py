"""Operators 11, 12 and 13 against plain Python, numpy and the tokenizer's library."""

import collections
import hashlib
import random
import zlib
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastemesh.llm import heapbpe, manifest, vocab, whitening
from tastemesh.llm.common import scratch_path
from llm_cases import pairs


def table_dir(spark, df, name="documents"):
    path = scratch_path(spark, "test-tables")
    df.write.parquet(f"{path}/{name}.parquet")
    return path


# ------------------------------------------------------------------ manifest (11)

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, n_chars):
    values = (row["doc_id"], row["source"], row["lang"], n_chars, row["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i:i + 2])) for i in range(0, len(last), 2)])
    return out


def way(tree, i):
    out = []
    for level in tree[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else None, j < i))
        i >>= 1
    return out


def manifest_rows(rows):
    trees = collections.defaultdict(list)
    for r in rows:
        trees[r["lang"]].append((r["doc_id"], leaf(r, r["n_chars"]), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in langs:
        trees[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        built[name] = levels([x[1] for x in trees[name]])
    top = levels([built[name][-1][0] for name in langs])
    out = collections.Counter()
    for k, name in enumerate(langs):
        for i, (doc_id, digest, r) in enumerate(trees[name]):
            steps = way(built[name], i) + way(top, k)
            h = digest
            if (doc_id is not None and r["n_chars"] is not None
                    and zlib.crc32(str(doc_id).encode()) % 7 == 0):
                h = leaf(r, r["n_chars"] + 1)
            for s, left in steps:
                h = sha(h) if s is None else sha(s + h) if left else sha(h + s)
            root = top[-1][0]
            out[doc_id, digest, built[name][-1][0], root,
                sha("".join(s for s, _ in steps if s)), h, h == root] += 1
    return out


FIELDS = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("table,tier", [("odd", 10), ("odd", 1), ("sample", 10), ("sample", 2),
                                        ("none", 10)])
def test_manifest_of_documents(request, spark, monkeypatch, table, tier):
    monkeypatch.setattr(manifest, "TIER", tier)
    docs = request.getfixturevalue(table)
    got = manifest.op11_postorder_merkle_manifest(spark, table_dir(spark, docs))
    assert got.columns[:7] == ["doc_id", "leaf", "subroot", "root", "proof_sha256",
                               "folded_root", "verified"]
    want = manifest_rows([r.asDict() for r in docs.select(*FIELDS).collect()])
    assert collections.Counter(map(tuple, got.collect())) == want


def test_manifest_of_many_small_trees(spark):
    """More languages than a range holds: the top tree has several tiers."""
    rows = [(i, "x", f"lang{i % 1500}" if i % 50 else None, None, i) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    got = manifest.op11_postorder_merkle_manifest(spark, table_dir(spark, docs)).collect()
    want = manifest_rows([dict(zip(FIELDS, r)) for r in rows])
    assert collections.Counter(map(tuple, got)) == want


@pytest.mark.parametrize("n", [*range(1, 40), 255, 256, 257, 1000])
def test_log_places_are_closed_form(n):
    """Every node of a closed log stands where the closed form says, for every size."""
    leaves = [bytes([i % 256]) * 32 for i in range(n)]
    builder = manifest.LogBuilder()
    for x in leaves:
        builder.append(x)
    root = builder.close(manifest.height(n))
    assert len(builder.log) == manifest.subtree_size(manifest.height(n), n)
    for at, (level, j) in enumerate(builder.made):
        assert manifest.position(level, j, n) == at
    assert root == bytes.fromhex(levels([x.hex() for x in leaves])[-1][0])
    for i in {0, n // 2, n - 1}:
        steps = manifest.way_of(i, 0, manifest.height(n), n, builder.log.__getitem__)
        assert manifest.fold(leaves[i], steps) == root
        assert n == 1 or manifest.fold(b"\0" * 31 + b"\1", steps) != root


def test_log_only_grows():
    """Appending never changes what was written for full subtrees."""
    builder, former = manifest.LogBuilder(), []
    for i in range(200):
        builder.append(bytes([i]) * 32)
        assert builder.log[:len(former)] == former
        assert len(builder.log) == manifest.nodes_before(i + 1)
        former = list(builder.log)


def test_saved_manifest_proves_asked_rows(spark, sample):
    rows = manifest.numbered(manifest.leaf_rows(sample), "doc_id", "leaf")
    path = scratch_path(spark, "test-manifest")
    manifest.Manifest.build(rows).save(path)
    kept = manifest.Manifest.load(spark, path)
    asked = rows.filter(F.col("doc_id") % 9 == 0).select("tree", "place", "doc_id", "leaf")
    got = kept.proofs(asked).collect()
    assert len(got) == asked.count() and all(bytes(r.folded) == kept.root for r in got)
    wrong = asked.withColumn("leaf", F.unhex(F.sha2(F.lit("other"), 256)))
    assert not any(bytes(r.folded) == kept.root for r in kept.proofs(wrong).collect())


# ------------------------------------------------------------------ token counts (12)

def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(
        model_file=vocab.vocabulary_path(heapbpe.PIECE_MODEL))


@pytest.mark.parametrize("table", ["odd", "sample", "none"])
def test_heap_counts_equal_the_library(request, spark, table):
    docs, sp = request.getfixturevalue(table), library()
    got = heapbpe.op12_heap_token_counts(spark, table_dir(spark, docs))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = collections.Counter()
    for i, t in pairs(docs):
        n = len(sp.encode(t))
        want[i, len(t.encode()), n, n > 4096] += 1
    assert collections.Counter(map(tuple, got.collect())) == want


def test_heap_counts_of_random_text():
    table = heapbpe.HeapCounts(vocab.vocabulary_path(heapbpe.PIECE_MODEL), most=500)
    sp, rnd = library(), random.Random(12)
    alphabet = list(" \n\t▁aeéß日本語x1́\0ÿ😀") + ["<s>", "</s>", "<0x0A>", "the", "in", "  ", "ing"]
    for _ in range(5000):
        t = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30)))
        assert table.count(t) == len(sp.encode(t)), repr(t)
    for t in (" " * 100, "a" * 10_000, "\n" * 50, " " * 37 + "x" + " " * 70, "ab" * 600_000):
        assert table.count(t) == len(sp.encode(t))
    assert len(table) <= 501


def test_heap_merges_in_rank_order_with_the_leftmost_first():
    class Small(heapbpe.HeapCounts):
        def __init__(self, ranks):
            self.rank = {p: r << heapbpe.PLACE_BITS for p, r in ranks.items()}
            self.single = set("abc")
    # bc goes before ab, so abc becomes a + bc although ab starts further left
    assert Small({"bc": 0, "ab": 1}).merge("abc") == 2
    assert Small({"aa": 0}).merge("aaaaa") == 3
    assert Small({"aa": 0, "aaaa": 1}).merge("aaaaa") == 2
    assert Small({}).merge("aé") == 3                       # two bytes without a piece


# ------------------------------------------------------------------ whitening (13)

def brute(vectors):
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, centred, values[::-1], vecs[:, ::-1], deviation


def check_whitening(rows, ids, vectors, tol=1e-9, unit=1e-9):
    n, centred, values, vecs, deviation = brute(vectors)
    k = max(r.component for r in rows)
    assert len(rows) == n * k
    assert {r.n for r in rows} == {n}
    want = collections.Counter(zip(ids, deviation))
    for c in range(1, k + 1):
        part = [r for r in rows if r.component == c]
        assert collections.Counter((r.vec_id, int(r.deviation_exact)) for r in part) == want
        assert all(r.deviation == (int(r.deviation_exact) if r.deviation_exact < 2 ** 63 else None)
                   for r in part)
        w = sorted(r.whitened for r in part)
        plus = centred @ vecs[:, c - 1] / np.sqrt(values[c - 1])
        assert min(np.abs(np.array(w) - np.sort(s * plus)).max() for s in (1, -1)) < tol
        assert abs(part[0].explained / (values[c - 1] / values.sum()) - 1) < unit
        assert part[0].identity_error < unit


def test_whitening_of_embeddings(spark, sf_small):
    got = whitening.op13_jacobi_davidson_whitening(spark, sf_small)
    assert got.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                               "identity_error"]
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()
    rows = got.collect()
    assert {r.component for r in rows} == set(range(1, 9))
    check_whitening(rows, [r.vec_id for r in table], [r.embedding for r in table])


def test_whitening_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rnd = random.Random(4)
    good = [(i % 30 or None, [rnd.gauss(0, k + 1) for k in range(5)]) for i in range(90)]
    good += [(7, [1.0] * 5), (7, [1.0] * 5), (8, [-0.0] * 5), (9, [1e6, -1e6, 0.5, 3.0, 2.0])]
    bad = [(1, None), (2, []), (3, [None] * 5), (4, [1.0, None, 2.0, 3.0, 4.0]),
           (5, [float("nan")] * 5), (6, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (None, None),
           (7, [1.0, 2.0, 3.0, 4.0, float("-inf")])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in good + bad],
                               "vec_id long, embedding array<double>, n int, component int")
    rows = whitening.op13_jacobi_davidson_whitening(
        spark, table_dir(spark, df.repartition(5), "embeddings")).collect()
    assert {r.component for r in rows} == set(range(1, 6))
    # the outlier of a million leaves the least component ten digits less
    check_whitening(rows, [i for i, _ in good], [v for _, v in good], tol=1e-5, unit=1e-5)


@pytest.mark.parametrize("vectors,components", [
    ([], 0), ([[1.0, 2.0]], 0), ([[1.0, 2.0]] * 5, 0), ([None, []], 0),
    ([[float(i), 2.0 * i, 5.0] for i in range(9)], 1)])
def test_whitening_without_variance(spark, vectors, components):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)],
                               "vec_id long, embedding array<float>")
    got = whitening.fit_whitening(df).transform()
    assert got.count() == components * len(vectors)
    assert set(got.columns) >= {"vec_id", "component", "whitened"}


def test_whitening_refuses_what_it_cannot_hold(spark):
    for vectors in ([[1.0, 2.0], [1.0]], [[1e300, 1.0], [1.0, 2.0]]):
        df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
        with pytest.raises(Exception, match="unlike lengths|beyond"):
            whitening.fit_whitening(df)


def test_deviation_beyond_a_long(spark):
    vectors = [[float(k) * 2 ** 30, 0.0] for k in range(8)]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")
    rows = whitening.fit_whitening(df).transform().collect()
    want = dict(enumerate(brute(vectors)[4]))
    assert all(r.deviation_exact == Decimal(want[r.vec_id]) for r in rows)
    assert any(r.deviation is None for r in rows)


@pytest.mark.parametrize("dim,gap", [(1, 1.0), (3, 1.0), (40, 1.0), (200, 1.0), (200, 0.01),
                                     (60, 0.0)])
def test_solver_reaches_double_precision(dim, gap):
    """Also with close and with equal eigenvalues."""
    rng = np.random.default_rng(dim)
    q = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    values = np.r_[100 + gap * np.arange(min(dim, 8))[::-1], rng.uniform(0, 99, max(0, dim - 8))]
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    calls = [0]

    def product(w):
        calls[0] += 1
        return v @ w
    got, vecs, residuals = whitening.leading_eigenpairs(product, dim)
    k = min(dim, 8)
    assert np.abs(got - np.sort(values)[::-1][:k]).max() < 1e-11 * 100
    assert np.linalg.norm(v @ vecs - vecs * got, axis=0).max() < 5e-12
    assert np.abs(vecs.T @ vecs - np.eye(k)).max() < 1e-12
    assert (np.abs(vecs).max(axis=0) == vecs.max(axis=0)).all()
