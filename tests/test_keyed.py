import pytest
from pyspark.sql import functions as F

from tastemesh.sources import keyed
from tastemesh.sources.lookup import lookup
from helpers import rows


def _table(spark, n=2000):
    return spark.range(n).select(
        F.when(F.col("id") % 50 != 7, F.format_string("k%05d", F.col("id") * 3)).alias("k"),
        F.col("id").alias("v"), F.array("id").alias("list"))


def _plain(df):
    return rows(df.select("k", "v"))


def test_layout_lookup_equals_the_join(spark, tmp_path):
    table = _table(spark)
    path = str(tmp_path / "t")
    keyed.write_layout(table, path, "k", files=16)
    assert rows(spark.read.parquet(f"{path}/rows").select(F.coalesce("k", F.lit("")), "v")) == rows(
        table.select(F.coalesce("k", F.lit("")), "v"))
    for wanted in ([], [None], ["k00000", "k00000", None], ["k00003", "k03000", "nothing"],
                   [f"k{i:05d}" for i in range(0, 6000, 7)]):
        keys = spark.createDataFrame([(k, 1) for k in wanted], "k string, v int")
        out = keyed.lookup(spark, path, keys, "k")
        assert out.columns == table.columns
        assert _plain(out) == _plain(lookup(table, keys, "k"))


def test_files_opened_are_bounded_by_the_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed.write_layout(_table(spark), path, "k", files=16)
    one = spark.createDataFrame([("k00300",)], "k string")
    assert len(keyed.files_for(spark, path, one, "k")) == 1
    # within every range, but no key of the table: the filters keep nearly all files shut
    absent = spark.createDataFrame([(f"k{i:05d}",) for i in range(1, 6000, 400) if i % 3], "k string")
    assert absent.count() >= 10
    assert len(keyed.files_for(spark, path, absent, "k")) <= 2
    out = keyed.lookup(spark, path, one, "k")
    assert len(out.inputFiles()) == 1


def test_hot_keys_integer_keys_and_empty_tables(spark, tmp_path):
    hot = spark.range(3000).select(
        F.when(F.col("id") < 1500, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    path = str(tmp_path / "hot")
    keyed.write_layout(hot, path, "k", files=8)
    five = spark.createDataFrame([(5,)], "k long")
    assert len(keyed.files_for(spark, path, five, "k")) > 1        # no file holds the hot key alone
    assert _plain(keyed.lookup(spark, path, five, "k")) == _plain(hot.filter("k = 5"))
    empty = str(tmp_path / "empty")
    keyed.write_layout(hot.limit(0), empty, "k")
    assert keyed.lookup(spark, empty, five, "k").collect() == []
    nulls = str(tmp_path / "nulls")
    keyed.write_layout(hot.limit(9).withColumn("k", F.lit(None).cast("long")), nulls, "k")
    assert keyed.lookup(spark, nulls, five, "k").collect() == []
    with pytest.raises(ValueError):
        keyed.write_layout(hot, str(tmp_path / "many"), "k", files=keyed.MAX_FILES + 1)
