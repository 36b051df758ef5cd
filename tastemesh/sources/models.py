"""Model persistence.

An ALS model only knows integer ids, so the two index tables are saved next
to it: a model loaded later maps its recommendations back to the original
keys without recomputing (and possibly renumbering) the indexes.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession


def save_als(model: ALSModel, user_index: DataFrame, business_index: DataFrame, path: str) -> None:
    base = path.rstrip("/")
    model.write().overwrite().save(f"{base}/model")
    user_index.write.mode("overwrite").parquet(f"{base}/user_index")
    business_index.write.mode("overwrite").parquet(f"{base}/business_index")


def load_als(spark: SparkSession, path: str) -> tuple[ALSModel, DataFrame, DataFrame]:
    base = path.rstrip("/")
    return (ALSModel.load(f"{base}/model"),
            spark.read.parquet(f"{base}/user_index"),
            spark.read.parquet(f"{base}/business_index"))
