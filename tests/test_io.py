import json
import os
import time

from tastemesh.operators import preprocess as P
from tastemesh.sources import sinks
from tastemesh.sources.catalog import Catalog, read_collection_json
from tastemesh.streaming.ingest import ingest_collection


def test_tsv_and_json_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([tuple(["a"] + [None] * 15)], ", ".join(
        f"{c} string" for c in P.TOPICAL_COLUMNS))
    out = str(tmp_path / "topical")
    sinks.write_lines(P.topical_lines(df), out)
    sinks.write_lines(P.topical_lines(df), out)  # append
    assert spark.read.text(out).count() == 2
    js = str(tmp_path / "json")
    sinks.write_json(df.select("business_id", "text"), js)
    back = spark.read.json(js).collect()
    assert back[0].business_id == "a"


def test_catalog_parquet_and_append(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "k string, v int")
    sinks.write_table(df, str(tmp_path / "t.parquet"))
    sinks.write_table(df, str(tmp_path / "t.parquet"))
    assert Catalog(spark, str(tmp_path), suffix=".parquet").load("t").count() == 2


def test_json_collection_import_and_stream_ingest(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    with open(src / "part1.json", "w") as f:
        f.write(json.dumps({"review_id": "r1", "user_id": "u", "business_id": "b",
                            "stars": "4.0", "text": "ok"}) + "\n")
    assert read_collection_json(spark, str(src), "review").count() == 1
    q = ingest_collection(spark, str(src), "review", str(tmp_path / "table"),
                          str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    with open(src / "part2.json", "w") as f:
        f.write(json.dumps({"review_id": "r2", "user_id": "v", "business_id": "b",
                            "stars": "2018-01-02", "text": None}) + "\n")
    q2 = ingest_collection(spark, str(src), "review", str(tmp_path / "table"),
                           str(tmp_path / "ckpt"), transform=P.drop_malformed_stars)
    q2.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "table")).select("review_id").collect()
    assert sorted(r.review_id for r in got) == ["r1"]  # each file once; malformed dropped
