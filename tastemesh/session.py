"""Session helpers: building a local session for tests/bench, and lineage cutting.

Library operators never create a session; they take DataFrames and return
DataFrames.  Only tests, ``bench.py`` and command-line use call
:func:`local_session`.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library is written for.  AQE re-plans joins at
# runtime (broadcast when a side turns out small, skew-join splitting of hot
# keys, partition coalescing), which is what keeps the plans sane from sf0.001
# up to cluster scale without per-query hints.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints go when the tables that read them are no longer in use
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tastemesh", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any.

    Reads ``spark.checkpoint.dir`` (or a directory already set on the
    context).  In local mode only, when nothing is configured, a fresh temp
    folder is set -- a single machine has no shared storage to prefer.  On a
    cluster an unset directory returns ``None`` and callers skip checkpoints
    rather than write to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tastemesh-ckpt-"))
        return sc.getCheckpointDir()
    return None


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder, removed when the application ends."""
    root = checkpoint_dir(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


#: Spark removes the shuffle files of a query that is made while this is set once it has run;
#: otherwise they stay until the driver happens to collect its garbage
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside leave no shuffle files behind."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(df: DataFrame, required: bool = False) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan must be evaluated exactly once (e.g. a nondeterministic
    range partitioning whose per-partition counts feed offsets), or between
    iterations whose lineage would otherwise grow.  Never a local checkpoint:
    the data must survive executor loss.
    """
    if checkpoint_dir(df.sparkSession) is None:
        if required:
            raise RuntimeError(
                "spark.checkpoint.dir is not set; this operator needs a shared "
                "checkpoint folder to materialise an intermediate result")
        return df
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared checkpoint folder, and read from there.

    For large intermediate tables that several steps read: like a checkpoint it is evaluated
    once and survives executor loss, but columns are encoded and compressed.
    """
    path = shared_path(df.sparkSession, "table")
    with shuffles_freed(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def dropped(table: DataFrame) -> None:
    """Removes a table that :func:`written` made, once no later step reads it."""
    removed(table.sparkSession, table._written_at)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder of this job's own intermediate tables that no later step reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
