"""Helpers shared by the training-data operators of this subpackage.

* :func:`texts` -- the two columns an operator reads, nulls as empty texts;
* :func:`written` -- an intermediate table in the shared folder that
  ``spark.checkpoint.dir`` names (lineage is cut by a table that every
  executor can read again, never by a local checkpoint);
* :func:`count_rows` -- a row count, for sizing partitions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SCRATCH: dict[str, str] = {}


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of a documents table; a null text reads as empty.

    Every other column stays behind here, so no extra column of the input
    can clash with a column that an operator makes.
    """
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local-mode session without the setting (tests) gets a folder of
    its own; a cluster without it raises, because no machine-local folder is
    visible to all executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="tastemesh-llm-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/tastemesh-llm/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder, read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]
