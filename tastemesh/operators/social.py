"""Social recommender: friend edges, weighted friend levels, recommendations.

Semantics (kept from the reference, with its defects fixed as noted):

* **Edges (G1)** -- one row per (user, friend) parsed from the comma-separated
  ``friends`` text; the ``None`` marker and empty entries are dropped, each
  element is trimmed, the full list is kept (not one friend per user).
* **Levels (G2)** -- L1 = edges; L2 = L1 ∪ L1∘L1; L3 = L2 ∪ L2∘L2, where
  ``∘`` is the friend-of-friend self-join.  L3 therefore reaches four hops.
  Every level is computed from an immutable snapshot of the previous one.
  ``friend_levels`` is the distinct union of (user, friend, weight) with
  weights 3, 2, 1 for L1, L2, L3, so a pair may carry several weights.
* **Recommendations (R1)** -- for each user, businesses reviewed with
  ``stars >= min_stars`` by anyone in the user's level set, not reviewed by
  the user, ranked by the number of such reviews (ties by business id), top k.

Everything is set-based: no adjacency map on the driver, no per-user job.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh.functions.strings import split_list
from tastemesh.operators.topk import top_k_per_group
from tastemesh.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_FRIENDS = "None"
LIST_ROWS = 256        # businesses in one shuffled row, about
SLICE_PAIRS = 1 << 14  # friends whose lists meet in one group, about


def stars_value(df: DataFrame, col: str = "stars"):
    """Numeric view of a stars column that may hold text (malformed rows → null)."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return F.col(col).try_cast("double")
    return F.col(col).cast("double")


def friend_edges(users: DataFrame, user_col: str = "user_id", friends_col: str = "friends",
                 trim: bool = True, none_marker: str = NO_FRIENDS) -> DataFrame:
    """(user_id, friend) distinct pairs from the friends text column.

    Friend ids are cast to the type of ``user_col`` so they join back to users;
    an entry that does not parse as an id is dropped.
    """
    id_type = users.schema[user_col].dataType
    e = users.select(F.col(user_col).alias("user_id"),
                     F.explode(split_list(friends_col, trim=trim)).alias("friend"))
    e = e.filter((F.col("friend") != F.lit(none_marker)) & (F.col("friend") != F.lit("")))
    if not isinstance(id_type, T.StringType):
        e = e.withColumn("friend", F.col("friend").try_cast(id_type))
    return e.filter(F.col("user_id").isNotNull() & F.col("friend").isNotNull()).distinct()


def expand_level(level: DataFrame) -> DataFrame:
    """One expansion step: level ∪ level∘level, distinct.

    The self-join is an equi-join on the middle vertex; a hot middle vertex
    (a celebrity friend) is split by AQE's skew-join handling.  The distinct
    runs partial aggregation map-side before its shuffle.
    """
    hop = level.select(F.col("user_id").alias("_mid"), F.col("friend").alias("_far"))
    two = level.join(hop, level.friend == hop._mid).select(
        F.col("user_id"), F.col("_far").alias("friend"))
    return level.unionByName(two).distinct()


def level_sets(edges: DataFrame, levels: int = 3, checkpoint: bool = False) -> list[DataFrame]:
    """[L1, L2, ..., Ln] as (user_id, friend) pair tables."""
    out = [edges]
    for _ in range(levels - 1):
        nxt = expand_level(out[-1])
        if checkpoint:
            nxt = cut_lineage(nxt)
        out.append(nxt)
    return out


def friend_levels(edges: DataFrame, levels: int = 3, checkpoint: bool = False) -> DataFrame:
    """(user_id, friend, weight) distinct union of all levels.

    Weight is ``levels`` for L1 down to 1 for the last level.  Every level is
    already a distinct pair set and carries its own weight, so the union is
    distinct without another shuffle.
    """
    sets = level_sets(edges, levels, checkpoint)
    parts = [s.withColumn("weight", F.lit(levels - i)) for i, s in enumerate(sets)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def two_hop_pairs(edges: DataFrame) -> DataFrame:
    """Friends and friends of friends per user as pairs."""
    return expand_level(edges)


def adjacency_json_lines(pairs: DataFrame) -> DataFrame:
    """One JSON object per (user, friend) pair (K4 re-aimed, see README).

    A single object per user would put a whole adjacency list -- unbounded for
    a hot user -- into one row; the pair form streams.
    """
    return pairs.select(F.to_json(F.struct("user_id", "friend")).alias("value"))


def _review_lists(reviews: DataFrame, min_stars: float) -> DataFrame:
    """(friend, liked, counts, all): each user's reviewed businesses in lists of about
    ``LIST_ROWS``: those with good reviews, how many, and all of them.  A user of many
    reviews has many lists, made in as many groups."""
    good = F.coalesce(stars_value(reviews) >= min_stars, F.lit(False))
    mine = (reviews.filter(F.col("business_id").isNotNull() & F.col("user_id").isNotNull())
            .groupBy(F.col("user_id").alias("friend"), "business_id")
            .agg(F.count_if(good).cast("int").alias("n")))
    sizes = mine.groupBy("friend").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).alias("_lists"))
    liked = F.when(F.col("n") > 0, F.struct("business_id", "n"))
    return (mine.join(sizes, "friend")
            .withColumn("_list", F.pmod(F.xxhash64("business_id"), F.col("_lists")))
            .repartition("friend", "_list").groupBy("friend", "_list")
            .agg(F.collect_list(liked).alias("_l"), F.collect_list("business_id").alias("all"))
            .select("friend", F.col("_l.business_id").alias("liked"),
                    F.col("_l.n").alias("counts"), "all"))


def _sums(k: int):
    """Rows (user_id, _slice, _own, ids, counts), sorted by user and slice, to the slice's ``k``
    businesses of the highest sums without own ones.  Batches are summed as they come; between
    them only the sums of the slice that may go on are held."""
    def other(a, b):
        import pyarrow.compute as pc
        no_a, no_b = pc.is_null(a), pc.is_null(b)
        return pc.if_else(pc.or_(no_a, no_b), pc.xor(no_a, no_b), pc.not_equal(a, b))

    def first(sums):
        import numpy as np
        import pyarrow.compute as pc
        t = sums.filter(pc.and_(pc.invert(sums["_own"]), pc.greater(sums["top_reviews"], 0)))
        t = t.sort_by([("user_id", "ascending"), ("_slice", "ascending"),
                       ("top_reviews", "descending"), ("business_id", "ascending")])
        new = np.ones(len(t), dtype=bool)
        for c in ("user_id", "_slice"):
            x = t[c].combine_chunks()
            differs = other(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
            new[1:] = differs if c == "user_id" else new[1:] | differs
        at = np.flatnonzero(new)
        place = np.arange(len(t)) - np.repeat(at, np.diff(np.r_[at, len(t)]))
        return t.select(["user_id", "business_id", "top_reviews"]).take(np.flatnonzero(place < k))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        held = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ids, at = batch.column("ids"), pc.list_parent_indices(batch.column("ids"))
            rows = pa.table([*[batch.column(c).take(at) for c in ("user_id", "_slice", "_own")],
                             pc.list_flatten(ids), pc.list_flatten(batch.column("counts")).cast("int64")],
                            ["user_id", "_slice", "_own", "business_id", "top_reviews"])
            if held is not None:
                rows = pa.concat_tables([held, rows.select(held.column_names)])
            sums = rows.group_by(["user_id", "_slice", "business_id"], use_threads=False).aggregate(
                [("top_reviews", "sum"), ("_own", "max")]).rename_columns(
                ["user_id", "_slice", "business_id", "top_reviews", "_own"])
            done = pc.or_(*[other(sums[c], batch.column(c)[-1]) for c in ("user_id", "_slice")])
            held = sums.filter(pc.invert(done))
            yield from first(sums.filter(done)).to_batches()
        if held is not None:
            yield from first(held).to_batches()
    return run


def social_recommendations(reviews: DataFrame, friend_pairs: DataFrame, k: int = 10,
                           min_stars: float = 3.0) -> DataFrame:
    """(user_id, business_id, top_reviews, rank) -- R1.

    ``friend_pairs`` is (user_id, friend); weights, if present, are ignored
    (a friend counts once however many levels reach it).  Reviews are
    pre-aggregated to (friend, business, n) before the join, so the join and
    the per-user sum move counts, not review rows.

    A row per user, friend and business would be the bulk of the job, shuffled, spilled by
    the sums and sorted by the ranking.  So friends bring their businesses in lists, which are
    shuffled once, by user, and summed as they stream by in the order of users.  A user of
    more than ``SLICE_PAIRS`` friends is cut into slices by business, one group each.
    """
    pairs = friend_pairs.select("user_id", "friend").distinct()
    lists = _review_lists(reviews, min_stars)
    hot = F.broadcast(pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_p"))
                      .filter(F.col("_p") > SLICE_PAIRS)
                      .select("user_id", F.ceil(F.col("_p") / SLICE_PAIRS).cast("int")
                              .alias("_slices")))
    reached = (pairs.join(hot, "user_id", "left")
               .join(lists.select("friend", "liked", "counts").filter(F.size("liked") > 0), "friend")
               .select("user_id", "_slices", F.lit(False).alias("_own"),
                       F.col("liked").alias("ids"), "counts"))
    # The user's own reviews join the same sums as markers, so the NOT IN is a
    # filter after one shuffle instead of an anti join over every candidate.
    own = (lists.select(F.col("friend").alias("user_id"), "all").join(hot, "user_id", "left")
           .select("user_id", "_slices", F.lit(True).alias("_own"), F.col("all").alias("ids"),
                   F.transform("all", lambda _: F.lit(0)).alias("counts")))
    slices = F.coalesce("_slices", F.lit(1))
    both = (reached.unionByName(own)
            .select("*", F.explode(F.sequence(F.lit(0), slices - 1)).alias("_slice")))

    def of_slice(name):
        inside = F.filter(F.arrays_zip("ids", "counts"),
                          lambda e: F.pmod(F.xxhash64(e["ids"]), slices) == F.col("_slice"))
        return F.when(slices == 1, F.col(name)).otherwise(
            F.transform(inside, lambda e: e[name])).alias(name)
    dealt = (both.select("user_id", "_slice", "_own", of_slice("ids"), of_slice("counts"))
             .repartition("user_id", "_slice").sortWithinPartitions("user_id", "_slice"))
    types = {f.name: f.dataType for f in reviews.schema}
    schema = T.StructType([T.StructField("user_id", dealt.schema["user_id"].dataType),
                           T.StructField("business_id", types["business_id"]),
                           T.StructField("top_reviews", T.LongType())])
    return top_k_per_group(dealt.mapInArrow(_sums(k), schema), ["user_id"],
                           [F.col("top_reviews").desc(), F.col("business_id").asc()], k)


def social_pipeline(users: DataFrame, reviews: DataFrame, k: int = 10, levels: int = 3,
                    min_stars: float = 3.0, trim: bool = True) -> DataFrame:
    """Edges → levels → recommendations in one lazily evaluated plan."""
    edges = friend_edges(users, trim=trim)
    pairs = level_sets(edges, levels)[-1]  # L1 ⊆ L2 ⊆ L3: the union's pairs are L3
    return social_recommendations(reviews, pairs, k=k, min_stars=min_stars)
