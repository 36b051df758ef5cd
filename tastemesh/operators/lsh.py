"""Nearest items by a hash index: random hyperplanes, multi-probe, exact re-ranking.

:func:`~tastemesh.operators.similarity.cosine_top_k` scores every pair, so its work
grows with the square of the catalogue.  Here items meet only in hash buckets:

1. *classes*: equal vectors become one class with its ``k + 1`` least ids -- no other
   member can be in anyone's list, because ties rank by id.  A group of copies costs
   one vector, whatever its size;
2. *index*: per table, ``bits`` random hyperplanes give a code; a bucket is a prefix
   of the code, as long as needed to hold at most ``leaf_rows`` classes (a hot bucket is split by
   more bits; one that no bit splits is dealt into chunks, all of which are probed);
3. *probes*: a query looks into its own bucket of every table, in a later round also
   into the buckets across its nearest hyperplanes, in the order of the squared margins;
4. *re-ranking*: buckets are cogrouped with the queries that probe them and scored
   exactly, tile by tile; lists merge to the best ``k``;
5. *check*: from a query's margins and the score ``s`` of its last found neighbour
   follows the probability that an item at that cosine lies in a probed bucket.
   Queries below ``target`` take part in the next round of probes; those below it
   after the last one -- their neighbours are too far for any hash -- go to the exact
   search instead.

So recall is near ``target`` or above on any data, and the work is near linear where
items have close neighbours.  On vectors without structure (noise) nearly every query
fails the check and the result is the exact one at the exact price.
"""

from __future__ import annotations

import math
import sys
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.functions.vectors import norm
from tastemesh.operators.similarity import TILE_ENTRIES, _block_topk, cosine_top_k
from tastemesh.operators.topk import top_k_per_group
from tastemesh.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLES, BITS = 8, 40
ROUNDS = (1, 6)     # buckets probed per table after each round
LEAF_ROWS = 1024
STEP = 3            # further bits of a bucket that holds too much
TARGET = 0.95       # least probability of finding an item as near as the last found one
SEED = 7


def hyperplanes(dim: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(dim, tables * bits): normals of the random hyperplanes, fixed by the seed."""
    return np.random.default_rng(seed).standard_normal((dim, tables * bits))


def margins(vectors: np.ndarray, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(rows, tables, bits): signed distances of unit vectors to the hyperplanes."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (unit @ hyperplanes(vectors.shape[1], tables, bits, seed)).reshape(
        len(vectors), tables, bits)


def codes_of(m: np.ndarray) -> np.ndarray:
    """(rows, tables): the sign bits, the first hyperplane's as the highest."""
    weight = 1 << np.arange(m.shape[2] - 1, -1, -1, dtype=np.int64)
    return (m >= 0) @ weight


def flips(margin: np.ndarray, depth: int, probes: int) -> list[tuple[int, ...]]:
    """The ``probes`` sets of up to three hyperplanes to cross, cheapest first, own
    bucket (none) included: sets of the nearest hyperplanes by their squared margins."""
    cost = margin[:depth] ** 2
    near = np.argsort(cost, kind="stable")[:max(4, 2 * math.isqrt(probes) + 2)].tolist()
    sets = [(0.0, ())]
    for size in (1, 2, 3):
        sets += [(float(sum(cost[j] for j in c)), c) for c in combinations(near, size)]
    sets.sort(key=lambda x: x[0])
    return [c for _, c in sets[:probes]]


def coverage(m: np.ndarray, depths, probes: int, s: float) -> float:
    """Probability that an item at cosine ``s`` of the query lies in a probed bucket.

    Given the query's margin a, the item's is normal around s a with variance
    1 - s^2; hyperplanes count as independent.
    """
    if s >= 1:
        return 1.0
    spread = math.sqrt(max(1e-12, 1 - s * s))
    missed = 1.0
    for margin, depth in zip(m, depths):
        same = np.array([0.5 * math.erfc(-max(s, 0.0) * abs(a) / spread / math.sqrt(2))
                         for a in margin[:depth]])
        own = float(np.prod(same))
        odds = (1 - same) / same
        found = sum(own * math.prod(odds[j] for j in c) for c in flips(margin, depth, probes))
        missed *= 1 - min(1.0, found)
    return 1 - missed


_SLICE_ROWS = 1 << 10       # queries whose probes are listed at once


def _cheapest(m: np.ndarray, depths: np.ndarray, probes: int):
    """:func:`flips` of all rows of margins (rows, bits) at once: the nearest hyperplanes (rows,
    near), and per probe (rows, probes, near) which of these it crosses; probes that a row has
    not, as its depth is small, are False in (rows, probes)."""
    cost = np.where(np.arange(m.shape[1]) < depths[:, None], m ** 2, np.inf)
    near = np.argsort(cost, axis=1, kind="stable")[:, :max(4, 2 * math.isqrt(probes) + 2)]
    cost = np.take_along_axis(cost, near, axis=1)
    sets = [c for size in range(4) for c in combinations(range(near.shape[1]), size)]
    price = np.stack([sum((cost[:, j] for j in c), np.zeros(len(m))) for c in sets], axis=1)
    first = np.argsort(price, axis=1, kind="stable")[:, :probes]
    crossed = np.zeros((len(sets), near.shape[1]), bool)
    for row, c in enumerate(sets):
        crossed[row, list(c)] = True
    return near, crossed[first], np.isfinite(np.take_along_axis(price, first, axis=1))


def _sliced(vector: pd.Series, depths: pd.Series, tables: int, bits: int, seed: int):
    """(row from, row to, margins (rows * tables, bits), depths (rows * tables)) in slices."""
    for lo in range(0, len(vector), _SLICE_ROWS):
        part = vector.iloc[lo:lo + _SLICE_ROWS]
        m = margins(np.stack(part.to_numpy()).astype(float), tables, bits, seed)
        yield lo, lo + len(part), m, np.concatenate(
            [np.asarray(d)[:tables] for d in depths.iloc[lo:lo + _SLICE_ROWS]])


def coverages(m: np.ndarray, depths: np.ndarray, probes: int, s: np.ndarray) -> np.ndarray:
    """:func:`coverage` of all rows of margins (rows, tables, bits) at once."""
    rows, tables, bits = m.shape
    flat = m.reshape(-1, bits)
    near, crossed, real = _cheapest(flat, depths, probes)
    spread = np.sqrt(np.maximum(1e-12, 1 - s * s))
    x = np.repeat(-np.maximum(s, 0.0) / spread / math.sqrt(2), tables)[:, None] * np.abs(flat)
    inside = np.arange(bits) < depths[:, None]
    same = np.ones(flat.shape)
    same[inside] = 0.5 * np.array([math.erfc(v) for v in x[inside].tolist()])
    own = same.prod(axis=1)
    odds = np.take_along_axis((1 - same) / same, near, axis=1)
    found = np.zeros(len(flat))
    for p in range(crossed.shape[1]):
        found += np.where(real[:, p], own * np.where(crossed[:, p], odds, 1.0).prod(axis=1), 0.0)
    missed = (1 - np.minimum(1.0, found)).reshape(rows, tables).prod(axis=1)
    return np.where(s >= 1, 1.0, 1 - missed)


def vector_classes(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(rep, vector, ids) per distinct vector -- its least id and its ``k + 1`` least
    ids -- and (business_id, rep) per item."""
    keyed = vectors.withColumn("_h", F.xxhash64("vector"))
    first = top_k_per_group(keyed, ["_h", "vector"], [F.col("business_id").asc()], k + 1, "_at")
    classes = cut_lineage(first.groupBy("_h", "vector").agg(
        F.array_sort(F.collect_list("business_id")).alias("ids"))
        .withColumn("rep", F.col("ids")[0]), required=True)
    members = keyed.join(classes.select("_h", "vector", "rep"), ["_h", "vector"])
    return classes.select("rep", "vector", "ids"), members.select("business_id", "rep")


class HashIndex:
    """Buckets of classes: ``leaves`` (t, depth, prefix, n, chunks) and ``members``
    (t, depth, prefix, chunk, rep).  Prefixes are free of one another."""

    def __init__(self, classes: DataFrame, tables: int = TABLES, bits: int = BITS,
                 leaf_rows: int = LEAF_ROWS, seed: int = SEED):
        self.classes, self.tables, self.bits = classes, tables, bits
        self.leaf_rows, self.seed = leaf_rows, seed
        n = classes.count()
        if n <= leaf_rows:
            self.tables = tables = 1                        # one bucket holds all
        self.base = min(bits, max(0, math.ceil(math.log2(max(1, n) / leaf_rows))))
        rows = cut_lineage(classes.select("rep", self._codes()("vector").alias("codes")), True)
        self.codes = rows
        rest = rows.select("rep", F.posexplode("codes").alias("t", "code"))
        levels, leaves, members = [], [], []
        depth = self.base
        while True:
            at = rest.withColumn("prefix", F.shiftright("code", bits - depth))
            counts = cut_lineage(at.groupBy("t", "prefix").agg(F.count(F.lit(1)).alias("n")), True)
            last = depth == bits
            small = counts if last else counts.filter(F.col("n") <= leaf_rows)
            chunks = F.ceil(F.col("n") / leaf_rows).cast("int")
            leaf = small.select("t", F.lit(depth).alias("depth"), "prefix", "n",
                                chunks.alias("chunks"))
            levels.append(depth)
            leaves.append(leaf)
            members.append(at.join(leaf, ["t", "prefix"]).select(
                "t", "depth", "prefix",
                F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk"), "rep"))
            if last or counts.filter(F.col("n") > leaf_rows).limit(1).count() == 0:
                break
            big = counts.filter(F.col("n") > leaf_rows).select("t", "prefix")
            rest = at.join(big, ["t", "prefix"], "left_semi").drop("prefix")
            depth = min(bits, depth + STEP)
        self.levels = levels
        self.leaves = cut_lineage(_union(leaves), True)
        self.members = _union(members)

    def _codes(self):
        tables, bits, seed = self.tables, self.bits, self.seed

        @F.pandas_udf("array<long>")
        def codes(vector: pd.Series) -> pd.Series:
            m = margins(np.stack(vector.to_numpy()).astype(float), tables, bits, seed)
            return pd.Series(list(codes_of(m)))
        return codes

    def _depths(self) -> DataFrame:
        """(rep, depths): the depth of a class's own bucket in every table."""
        return self.members.groupBy("rep").agg(F.sort_array(F.collect_list(
            F.struct("t", "depth"))).alias("_d")).select("rep", F.col("_d.depth").alias("depths"))

    def probes(self, queries: DataFrame, probes: int, done: int = 0) -> DataFrame:
        """(rep, t, depth, prefix, chunk): the buckets that the query classes look into, from
        the ``done``-th cheapest on."""
        tables, bits, seed = self.tables, self.bits, self.seed

        @F.pandas_udf("array<struct<t:int,code:long>>")
        def wanted(vector: pd.Series, depths: pd.Series) -> pd.Series:
            out = []
            for lo, hi, m, each in _sliced(vector, depths, tables, bits, seed):
                near, crossed, real = _cheapest(m.reshape(-1, bits), each, probes)
                bit = np.left_shift(np.int64(1), (bits - 1 - near).astype(np.int64))
                code = codes_of(m).reshape(-1, 1) ^ np.where(crossed, bit[:, None, :], 0).sum(axis=2)
                code, real = (x[:, done:].reshape(hi - lo, tables, -1) for x in (code, real))
                out += [[{"t": t, "code": c} for t in range(tables)
                         for c in code[r, t][real[r, t]].tolist()] for r in range(hi - lo)]
            return pd.Series(out)

        asked = (queries.join(self._depths(), "rep")
                 .select("rep", F.explode(wanted("vector", "depths")).alias("w"))
                 .select("rep", "w.t", "w.code")
                 .withColumn("depth", F.explode(F.array(*map(F.lit, self.levels))))
                 .withColumn("prefix", F.expr(f"shiftright(code, {bits} - depth)")))
        found = asked.join(self.leaves, ["t", "depth", "prefix"])
        return found.select("rep", "t", "depth", "prefix", F.explode(F.sequence(
            F.lit(0), F.col("chunks") - 1)).alias("chunk")).distinct()

    def scored(self, queries: DataFrame, probes: int, k: int, digits: int | None,
               done: int = 0) -> DataFrame:
        """(input, business_id, score): the best ``k`` classes of every probed bucket."""
        vectors = self.classes.select("rep", "vector", norm("vector").alias("_norm"))
        keys = ["t", "depth", "prefix", "chunk"]

        def side(buckets):
            # aliases of its own: both sides come from one table
            return buckets.join(vectors, "rep").select(
                *[F.col(c).alias(c) for c in keys], F.col("rep").alias("business_id"),
                F.col("vector").alias("vector"), F.col("_norm").alias("_norm"))
        q, c = side(self.probes(queries, probes, done)), side(self.members)
        kind = self.classes.schema["rep"].dataType
        schema = T.StructType([T.StructField("input", kind), T.StructField("business_id", kind),
                               T.StructField("score", T.DoubleType())])
        return (q.groupBy(*keys).cogroup(c.groupBy(*keys))
                .applyInPandas(_block_topk(k, digits, TILE_ENTRIES), schema))

    def covered(self, queries: DataFrame, probes: int, best: DataFrame, k: int,
                target: float) -> DataFrame:
        """(rep): the query classes whose last found neighbour would be found with a
        probability of ``target`` or more."""
        tables, bits, seed = self.tables, self.bits, self.seed

        @F.pandas_udf("double")
        def chance(vector: pd.Series, depths: pd.Series, s: pd.Series) -> pd.Series:
            out = np.zeros(len(s))
            for lo, hi, m, each in _sliced(vector, depths, tables, bits, seed):
                out[lo:hi] = coverages(m, each, probes, s.to_numpy(float)[lo:hi])
            return pd.Series(out)
        last = best.groupBy("input").agg(F.count(F.lit(1)).alias("_n"), F.min("score").alias("_s"))
        full = last.filter(F.col("_n") >= k).select(F.col("input").alias("rep"), "_s")
        return (queries.join(self._depths(), "rep").join(full, "rep")
                .filter(chance("vector", "depths", "_s") >= target).select("rep"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cosine_top_k_lsh(vectors: DataFrame, k: int = 10, digits: int | None = None,
                     rounds: tuple[int, ...] = ROUNDS, target: float = TARGET,
                     id_col: str = "business_id", vec_col: str = "vector",
                     parts: dict | None = None, **index) -> DataFrame:
    """(input, business_id, score, rank): the ``k`` most similar other items of every
    item with a non-zero vector, by the hash index.

    ``parts``, if given, receives the index, the queries of every round and those
    that went to the exact search (``index``, ``asked``, ``rest``) for measuring.
    """
    items = (vectors.select(F.col(id_col).alias("business_id"), F.col(vec_col).alias("vector"))
             .filter(F.col("business_id").isNotNull() & (norm("vector") > 0)))
    classes, members = vector_classes(items, k)
    buckets = HashIndex(classes, **index)
    want = k + 1                                            # a class is among its own nearest
    order = [F.col("score").desc(), F.col("business_id").asc()]
    rest, best, lists, asked, done = classes.select("rep", "vector"), None, [], [], 0
    for probes in rounds:
        asked.append((rest, probes, done))
        new = buckets.scored(rest, probes, want, digits, done)
        if best is not None:
            new = new.unionByName(best.select("input", "business_id", "score"))
        # a pair that met in several buckets counts once (its scores differ in the last bit)
        new = new.groupBy("input", "business_id").agg(F.max("score").alias("score"))
        best = cut_lineage(top_k_per_group(new, ["input"], order, want, "_at"), True)
        near = cut_lineage(buckets.covered(rest, probes, best, want, target), True)
        lists.append(best.join(near, best["input"] == near["rep"], "left_semi")
                     .select("input", "business_id", "score"))
        rest = cut_lineage(rest.join(near, "rep", "left_anti"), True)
        best = best.join(rest.select("rep"), best["input"] == F.col("rep"), "left_semi")
        done = probes
        if rest.limit(1).count() == 0:
            break
    else:
        far = rest.withColumnRenamed("rep", "business_id")
        exact = cosine_top_k(far, classes.select(F.col("rep").alias("business_id"), "vector"),
                             k=want, digits=digits, exclude_self=False,
                             queries_within_candidates=True)
        lists.append(exact.select("input", "business_id", "score"))
    # classes back to items: the least ids of each class, then the items of the query's class
    ids = classes.select(F.col("rep").alias("business_id"), F.explode("ids").alias("_id"))
    by_item = top_k_per_group(
        _union(lists).join(ids, "business_id").select("input", "_id", "score"),
        ["input"], [F.col("score").desc(), F.col("_id").asc()], want, "_at")
    out = (members.join(by_item, members["rep"] == by_item["input"])
           .select(F.col("business_id").alias("input"), F.col("_id").alias("business_id"), "score")
           .filter(F.col("input") != F.col("business_id")))
    if parts is not None:
        parts |= {"index": buckets, "asked": asked, "rest": rest}
    return top_k_per_group(out, ["input"], order, k)


def scored_pairs(parts: dict) -> int:
    """Pairs that the index scored: the sum of the probed buckets' sizes over all rounds."""
    index, total = parts["index"], 0
    for queries, probes, done in parts["asked"]:
        found = index.probes(queries, probes, done).filter("chunk = 0")
        total += found.join(index.leaves, ["t", "depth", "prefix"]).agg(
            F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return total
