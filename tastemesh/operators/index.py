"""Dense integer ids for string/long keys (W1) and the joins around them
(J1, J2, J9, X4, X5).

``dense_index`` gives every distinct key its rank in key order, 0-based and
contiguous: the result equals ``row_number() over (order by key) - 1`` but is
computed without a single-partition window:

1. distinct keys are range-partitioned and sorted within partitions;
2. each row takes its position inside its partition
   (``monotonically_increasing_id`` minus the partition base);
3. that table is checkpointed, so the per-partition counts and the positions
   come from one materialisation (range boundaries are sampled and need not
   repeat on a re-run);
4. per-partition counts (one row per partition -- bounded by the partition
   count) give prefix offsets, broadcast back to every row.

The same steps rank rows by any total order (``global_positions``), which is
how a global top-k with a large ``k`` (a capped vocabulary) is cut without
funnelling ``k`` rows per map task into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastemesh.operators.social import stars_value
from tastemesh.session import cut_lineage

_PARTITION_SHIFT = 33  # monotonically_increasing_id: partition id in the upper bits


def global_positions(df: DataFrame, order_cols: Sequence[Column], out: str,
                     num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the 0-based position of every row in the total
    order ``order_cols`` -- ``row_number() over (order by ...) - 1`` without
    a single-partition window (steps 1-4 above).  The order must be unique
    per row for the positions to be deterministic.  Needs a checkpoint folder.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .select(*cols, F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    ranged = cut_lineage(ranged, required=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # counts has one row per partition: a global window over it is tiny
    prefix = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(prefix), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _PARTITION_SHIFT)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_off") + local).alias(out)))


def dense_index(df: DataFrame, key: str, out: str, num_partitions: int | None = None) -> DataFrame:
    """(key, out) with ``out`` = 0-based rank of ``key`` among distinct non-null keys.

    ``out`` is an ``int`` (the reference casts to int for the factorisation);
    under ANSI mode an index beyond the int range raises instead of wrapping.
    """
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    pos = global_positions(keys, [F.col(key)], "_pos", num_partitions)
    return pos.select(key, F.col("_pos").cast("int").alias(out))


def attach_index(df: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``select t.*, int(idx) from t, index where t.key = index.key``."""
    return df.join(index, key)


def rating_triples(review: DataFrame, user_index: DataFrame, business_index: DataFrame,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """(user_idx int, business_idx int, rating float) per review.

    The rating is a ``try_cast`` of stars: a malformed value gives a null
    rating instead of failing the job under ANSI mode (X5).
    """
    r = review.select("user_id", "business_id", stars_value(review).cast("float").alias("rating"),
                      *keep)
    return (r.join(user_index, "user_id").join(business_index, "business_id")
            .select("user_idx", "business_idx", "rating", *keep))


def map_back(df: DataFrame, index: DataFrame, idx_col: str) -> DataFrame:
    """Replace an integer id by its key."""
    return df.join(index, idx_col).drop(idx_col)
