"""Sharding (operator 6): a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``RING`` places.  Every shard owns ``VIRTUAL`` virtual nodes at
hashed places; a key hashes to a place and belongs to the first virtual node
clockwise from there.  A shard takes at most its bound; a key that meets a
full shard goes on clockwise to the next shard with room.  Keys enter in
ring order (place, then key hash), so the outcome depends on the set of rows
alone, not on files or partitions.

With ``slack=0`` the bounds are the floors and ceilings of n / shards, so row
counts differ by at most one (law ``rows``); with a larger slack a bound is
ceil((1 + slack) · n / shards), fewer keys overflow and fewer move when a shard
is added.

Distribution: keys of one place share their way round the ring, so counts per
place decide everything.  The driver sees at most ``RING`` counts (a bound that
does not grow with the data), walks the ring once and gives every place a list
of (shard, how many, first slot); all ranks within places come from windows
over places and 16 sub-cells of a place.  Equal rows are counted before any
shuffle and spread out again afterwards, so a repeated row is no hot key.

Defined cases: a null text has size 1 (0 bytes plus 1) and the crc32 of no
bytes; null doc_ids hash alike and are spread by their sub-cells; repeated
rows get one slot each; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemesh.llm.common import documents, texts, written

N_SHARDS = 16
RING = 1 << 16
VIRTUAL = 256
SUBCELLS = 16


def virtual_nodes(n_shards: int, virtual: int = VIRTUAL, ring: int = RING) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node, clockwise.  A shard's places depend on
    its own number alone, so a further shard leaves all others where they are."""
    def place(shard, v):
        digest = hashlib.blake2b(f"shard {shard} node {v}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big") % ring
    return sorted((place(s, v), s) for s in range(n_shards) for v in range(virtual))


def bounds(n_rows: int, n_shards: int, slack: float) -> list[int]:
    if slack == 0:
        return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]
    return [-(-int((1 + slack) * n_rows) // n_shards) + 1] * n_shards


def walk(counts: dict[int, int], n_shards: int, slack: float = 0.0, virtual: int = VIRTUAL,
         ring: int = RING) -> list[tuple[int, int, int, int, int]]:
    """(place, lo, hi, shard, first_slot): the keys ranked lo..hi-1 of a place go to
    ``shard``, from ``first_slot`` on."""
    nodes = virtual_nodes(n_shards, virtual, ring)
    room = bounds(sum(counts.values()), n_shards, slack)
    used = [0] * n_shards
    out, node = [], 0
    for place in sorted(counts):
        while node < len(nodes) and nodes[node][0] < place:
            node += 1
        lo, left, step = 0, counts[place], 0
        while left:
            shard = nodes[(node + step) % len(nodes)][1]
            take = min(left, room[shard] - used[shard])
            if take:
                out.append((place, lo, lo + take, shard, used[shard]))
                used[shard] += take
                lo, left = lo + take, left - take
            step += 1
    return out


def place_keys(rows: DataFrame, key: str, n_shards: int = N_SHARDS, slack: float = 0.0,
               virtual: int = VIRTUAL, ring: int = RING) -> DataFrame:
    """``rows`` (narrow: keys and small columns) with shard and slot."""
    spark, cols = rows.sparkSession, rows.columns
    same = (rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_place", F.pmod(F.xxhash64(F.col(key)), F.lit(ring)).cast("int"))
            .withColumn("_order", F.xxhash64(*[F.col(c) for c in cols]))
            .withColumn("_cell", F.pmod(F.col("_order"), F.lit(SUBCELLS)).cast("int")))
    same = written(same, "ring")
    cells = same.groupBy("_place", "_cell").agg(F.sum("_n").alias("_in_cell"))
    before_cell = (Window.partitionBy("_place").orderBy("_cell")
                   .rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("_place", "_cell", F.coalesce(
        F.sum("_in_cell").over(before_cell), F.lit(0)).alias("_base"))
    per_place = same.groupBy("_place").agg(F.sum("_n").alias("n")).collect()  # <= ring rows
    way = walk({r["_place"]: r["n"] for r in per_place}, n_shards, slack, virtual, ring)
    segments = spark.createDataFrame(  # <= ring + n_shards * places that fill one: bounded
        pd.DataFrame(way, columns=["_place", "_lo", "_hi", "shard", "_first"]),
        "_place int, _lo long, _hi long, shard int, _first long")
    in_cell = (Window.partitionBy("_place", "_cell").orderBy("_order", *cols)
               .rowsBetween(Window.unboundedPreceding, -1))
    ranked = (same.withColumn("_in", F.coalesce(F.sum("_n").over(in_cell), F.lit(0)))
              .join(cells, ["_place", "_cell"])
              .withColumn("_rank", F.explode(F.sequence(F.col("_base") + F.col("_in"),
                                                        F.col("_base") + F.col("_in")
                                                        + F.col("_n") - 1))))
    s = F.broadcast(segments)
    return (ranked.join(s, (ranked["_place"] == s["_place"]) & (F.col("_rank") >= F.col("_lo"))
                        & (F.col("_rank") < F.col("_hi")))
            .select(*[ranked[c] for c in cols], "shard",
                    (F.col("_first") + F.col("_rank") - F.col("_lo")).alias("slot")))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, slack: float = 0.0,
                    **options) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document."""
    text = F.col("text").cast("binary")
    rows = texts(docs).select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"))
    return place_keys(rows, "doc_id", n_shards, slack, **options)


def op6_bounded_load_ring(spark, sf_dir: str) -> DataFrame:
    return (shard_documents(documents(spark, sf_dir))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
