"""Keyed lookups that open few files (S10, J8): a layout by key with a side table per file.

:func:`write_layout` deals a table by ranges of its key and writes

    rows/     the table, each file a range of keys, sorted by key
    ranges/   one row a file: its least and greatest key, rows, words of its filter
    filters/  (file, word, mask): a blocked Bloom filter of the keys of each file

:func:`files_for` finds the files that can hold any key of a batch: first by range,
then by filter; :func:`lookup` reads those alone.  The ranges, one row a file and at most
``MAX_FILES``, are the only thing that the driver sees.  A filter is a table of 64-bit
words, so none passes through a task whole; a key marks ``MARKS`` bits of one word, and at
``BITS_PER_KEY`` bits a key about one file in a hundred is opened for nothing.

Defined cases: rows with a null key are kept and never found, null keys of a batch find
nothing; repeated keys of the table all come back, repeated keys of a batch change
nothing; a hot key spans as many files as it needs (rows of equal keys are
dealt by a hash of their other columns); an empty table and an empty batch give no rows.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_FILES = 1 << 16
BITS_PER_KEY = 16
MARKS = 4


def _mask(key: Column) -> Column:
    """``MARKS`` bits of a 64-bit word, from the second hash of the key."""
    h = F.xxhash64(F.lit(1), key)
    out = F.lit(0).cast("long")
    for i in range(MARKS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return out


def _word(key: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(key), words)


def write_layout(table: DataFrame, path: str, on: str, files: int = 64) -> None:
    """Write ``table`` to the new folder ``path`` for lookups by the column ``on``."""
    if not 1 <= files <= MAX_FILES:
        raise ValueError(f"a layout has 1 to {MAX_FILES} files, not {files}")
    spark = table.sparkSession
    plain = [f.name for f in table.schema
             if not isinstance(f.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType))]
    (table.repartitionByRange(files, F.col(f"`{on}`"),
                              F.xxhash64(*[F.col(f"`{c}`") for c in plain]))
     .sortWithinPartitions(F.col(f"`{on}`")).write.parquet(f"{path}/rows"))
    keys = (spark.read.schema(table.schema).parquet(f"{path}/rows")
            .select(F.col("_metadata.file_name").alias("file"), F.col(f"`{on}`").alias("key"))
            .filter("key is not null"))
    words = F.ceil(F.count(F.lit(1)) * F.lit(BITS_PER_KEY) / F.lit(64)).cast("long")
    (keys.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("most"),
                              F.count(F.lit(1)).alias("rows"), words.alias("words"))
     .write.parquet(f"{path}/ranges"))
    few = F.broadcast(_ranges(spark, path).select("file", "words"))     # at most MAX_FILES rows
    (keys.join(few, "file").select("file", _word(F.col("key"), F.col("words")).alias("word"),
                                   _mask(F.col("key")).alias("mask"))
     .groupBy("file", "word").agg(F.bit_or("mask").alias("mask"))
     .write.parquet(f"{path}/filters"))


def _ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ranges")


def files_for(spark: SparkSession, path: str, keys: DataFrame, on: str) -> list[str]:
    """The names of the files that can hold one of ``keys`` (column ``on``)."""
    ranges = _ranges(spark, path)
    found = ranges.orderBy("least", "most").collect()                   # at most MAX_FILES rows
    if not found:
        return []
    least, most = [r["least"] for r in found], [r["most"] for r in found]

    def by_range(batches):
        for batch in batches:
            out = [(k, i) for k in batch["key"].tolist()
                   for i in range(bisect_left(most, k), bisect_right(least, k))]
            yield pd.DataFrame(out, columns=["key", "at"])

    key_type = ranges.schema["least"].dataType
    wanted = (keys.select(F.col(f"`{on}`").cast(key_type).alias("key"))
              .filter("key is not null").distinct())
    numbers = spark.createDataFrame([(i, r["file"], r["words"]) for i, r in enumerate(found)],
                                    "at long, file string, words long")
    near = (wanted.mapInPandas(by_range, T.StructType([T.StructField("key", key_type),
                                                       T.StructField("at", T.LongType())]))
            .join(F.broadcast(numbers), "at")
            .select("file", _word(F.col("key"), F.col("words")).alias("word"),
                    _mask(F.col("key")).alias("m")))
    hits = (near.join(spark.read.parquet(f"{path}/filters"), ["file", "word"])
            .filter(F.col("mask").bitwiseAND(F.col("m")) == F.col("m")))
    return sorted(r["file"] for r in hits.select("file").distinct().collect())


def lookup(spark: SparkSession, path: str, keys: DataFrame, on: str) -> DataFrame:
    """The rows of a layout whose ``on`` is among ``keys``, from the files that can hold them."""
    schema = spark.read.parquet(f"{path}/rows").schema
    names = files_for(spark, path, keys, on)
    if not names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f"{path}/rows/{n}" for n in names])
    return rows.join(keys.select(on), on, "left_semi").select(*schema.names)
