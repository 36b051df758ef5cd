"""End-to-end jobs on a small collection set with string ids (JSON lines)."""

import json
import random

import pytest

from tastemesh import jobs
from tastemesh.schema import SCHEMAS
from tastemesh.sources.catalog import Catalog

WORDS = ["tasty", "pizza", "slow", "service", "great", "noodle", "spicy", "cheap", "cozy",
         "loud", "fresh", "salad", "burger", "friendly", "rude", "clean", "wine", "beer",
         "sushi", "taco"]


@pytest.fixture(scope="module")
def collections_root(tmp_path_factory):
    rnd = random.Random(5)
    root = tmp_path_factory.mktemp("collections")
    cities = ["Las Vegas", "Las Vegas", "Reno"]
    cats = ["Food, Restaurants", "Restaurants", "Bars", "restaurants,Bars", None]
    biz = [{"business_id": f"b{i}", "name": f"Place {i}", "city": cities[i % 3],
            "categories": cats[i % 5], "latitude": 36.0 + i / 100, "longitude": -115.0 - i / 100,
            "stars": 3.5, "review_count": 0, "is_open": 1} for i in range(30)]
    users = []
    for i in range(40):
        friends = "None" if i % 7 == 0 else ", ".join(f"u{(i * m + 1) % 40}" for m in (3, 5))
        users.append({"user_id": f"u{i}", "name": f"User {i}", "review_count": 0,
                      "friends": friends, "useful": 0, "funny": 0, "cool": 0, "fans": 0})
    reviews = []
    for j in range(400):
        stars = str(float(rnd.randint(1, 5))) if j % 50 else "2018-01-02"
        reviews.append({"review_id": f"r{j}", "user_id": f"u{rnd.randrange(40)}",
                        "business_id": f"b{rnd.randrange(30)}", "stars": stars,
                        "text": " ".join(rnd.choice(WORDS) for _ in range(12))})
    for name, rows in (("business", biz), ("user", users), ("review", reviews)):
        d = root / name
        d.mkdir()
        with open(d / "part-0.json", "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(root)


def test_all_jobs_run_on_string_ids(spark, collections_root, tmp_path):
    cat = Catalog(spark, collections_root, fmt="json", schemas=SCHEMAS)
    out = str(tmp_path)
    jobs.preprocess_job(cat, f"{out}/pre")
    assert spark.read.parquet(f"{out}/pre/business").count() > 0
    rf = spark.read.parquet(f"{out}/pre/review")
    assert rf.filter("stars like '%-%-%'").count() == 0 and "avg_rating" in rf.columns

    jobs.topical_job(cat, f"{out}/topical")
    lines = spark.read.text(f"{out}/topical").collect()
    assert lines and all(len(r.value.split("\t")) >= 16 for r in lines)

    rmse = jobs.collaborative_job(cat, f"{out}/collab", f"{out}/model")
    assert rmse == rmse
    collab = spark.read.parquet(f"{out}/collab")
    assert collab.count() > 0 and all(len(r.business_id) <= 10 for r in collab.collect())
    jobs.model_recommendations_job(spark, f"{out}/model", f"{out}/collab2")
    assert sorted(map(tuple, spark.read.parquet(f"{out}/collab2").collect())) == \
        sorted(map(tuple, collab.collect()))

    jobs.content_job(cat, f"{out}/content")
    details = spark.read.parquet(f"{out}/content/details")
    assert details.count() > 0 and {"name", "score", "rank"} <= set(details.columns)

    jobs.social_job(cat, f"{out}/social")
    soc = spark.read.parquet(f"{out}/social")
    assert soc.count() > 0 and soc.groupBy("user_id").count().agg({"count": "max"}).collect()[0][0] <= 10

    jobs.hybrid_job(spark, cat, {"collaborative": f"{out}/collab", "social": f"{out}/social"},
                    f"{out}/hybrid")
    hy = spark.read.parquet(f"{out}/hybrid")
    assert {r.type for r in hy.select("type").distinct().collect()} == {"collaborative", "social"}


def test_jobs_chain_through_the_command_line(spark, collections_root, tmp_path):
    out = str(tmp_path)
    jobs.main(["preprocess", "--input", collections_root, "--format", "json",
               "--output", f"{out}/pre"])
    jobs.main(["collaborative", "--input", f"{out}/pre", "--output", f"{out}/collab",
               "--model", f"{out}/model"])
    jobs.main(["content", "--input", f"{out}/pre", "--output", f"{out}/content"])
    jobs.main(["social", "--input", collections_root, "--format", "json",
               "--output", f"{out}/social"])
    jobs.main(["hybrid", "--input", f"{out}/pre", "--output", f"{out}/hybrid",
               "--source", f"collaborative={out}/collab",
               "--source", f"context={out}/content/lines",
               "--source", f"social={out}/social"])
    hy = spark.read.parquet(f"{out}/hybrid")
    got = {(r.type, r.type_order) for r in hy.select("type", "type_order").distinct().collect()}
    assert got == {("collaborative", 0), ("context", 1), ("social", 2)}
    # the context list reads back in its stored order
    recs = {(r.user_id, r.rank, r.business_id)
            for r in spark.read.parquet(f"{out}/content/recs").collect()}
    back = {(r.user_id, r["rank"], r.business_id)
            for r in hy.filter("type = 'context'").collect()}
    assert back == recs
    # the social job honours its filters: only businesses of the cascade come out
    kept = {r.business_id for r in spark.read.parquet(f"{out}/pre/business").collect()}
    assert {r.business_id for r in spark.read.parquet(f"{out}/social").collect()} <= kept


def test_model_argument_is_asked_for_at_once(collections_root, tmp_path):
    with pytest.raises(SystemExit):
        jobs.main(["collaborative", "--input", collections_root, "--output", str(tmp_path)])


def test_cli_runs_social(spark, collections_root, tmp_path):
    jobs.main(["social", "--input", collections_root, "--format", "json", "--city", "",
               "--output", str(tmp_path / "s")])
    assert spark.read.parquet(str(tmp_path / "s")).count() > 0
