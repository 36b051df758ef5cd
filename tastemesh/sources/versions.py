"""Dense ids that stay (W1, S8): an index that continues, as a table of commits.

A dense index built anew renumbers its keys whenever one is added, and a saved model
no longer fits.  Here a version only adds: keys that have an id keep it, new keys get the
ids behind the highest, in key order.  Each version is one commit, so a repeated job
changes nothing and a failed one leaves the former version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemesh.operators.index import dense_index
from tastemesh.sources import commits


def extended_index(index: DataFrame | None, df: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out) of the keys of ``df`` that ``index`` lacks, numbered on from it."""
    if index is None:
        return dense_index(df, key, out)
    known = index.select(key)
    fresh = df.select(key).filter(F.col(key).isNotNull()).join(known, key, "left_anti")
    first = index.agg(F.coalesce(F.max(out) + 1, F.lit(0))).first()[0]
    return dense_index(fresh, key, out).select(
        key, (F.col(out) + F.lit(first)).cast("int").alias(out))


def update_index(spark: SparkSession, path: str, df: DataFrame, key: str, out: str,
                 job: str) -> DataFrame:
    """The index at ``path`` after the keys of ``df`` have been added under ``job``."""
    there = commits.is_committed_table(spark, path) and commits.manifests(spark, path)
    if not (there and job in there):
        index = commits.read(spark, path) if there else None
        commits.commit(extended_index(index, df, key, out), path, job,
                       metrics={"highest": F.max(out)})
    return commits.read(spark, path)
