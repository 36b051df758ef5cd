"""Appends that count once: a table of whole commits.

A plain append repeats its rows when a job runs twice and shows parts of a table when
a job of several tables fails half way.  Here a table is a folder:

    data/<job>-<attempt>/   the files of one attempt, written by Spark's own committer
    _commits/<job>.json     the manifest: folder, schema, observed figures, what it replaces

:func:`commit` writes the attempt, then publishes its manifest by one rename that fails
if the job has a manifest already.  So a repeated job adds nothing, an attempt that
died before the rename is never read (a retry writes a folder of its own), and of two
attempts that race one wins whole.  The rename must be atomic, as on HDFS and local
disks.  Readers list the manifests: as many as there were jobs, never the files.

Figures of a job come with the write (``DataFrame.observe``): no second pass.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_JOB = re.compile(r"[A-Za-z0-9._=-]+")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def is_committed_table(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, f"{path}/_commits")
    return fs.exists(p)


def manifests(spark: SparkSession, path: str) -> dict[str, dict]:
    """job -> manifest of every published commit."""
    fs, folder = _fs(spark, f"{path}/_commits")
    if not fs.exists(folder):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    names = [n for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
    if not names:
        return {}
    rows = spark.read.text([f"{path}/_commits/{n}" for n in names], wholetext=True).collect()
    found = [json.loads(r["value"]) for r in rows]                    # one small file a job
    return {m["job"]: m for m in found}


def visible(all_manifests: dict[str, dict]) -> list[dict]:
    """The commits that readers see: those no other commit replaces."""
    gone = {job for m in all_manifests.values() for job in m["replaces"]}
    return [m for job, m in sorted(all_manifests.items()) if job not in gone]


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all visible commits; raises if the table has none."""
    seen = visible(manifests(spark, path))
    if not seen:
        raise FileNotFoundError(f"no commit in {path}")
    schema = T.StructType.fromJson(seen[0]["schema"])
    return spark.read.schema(schema).parquet(*[f"{path}/{m['folder']}" for m in seen])


def load(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table of commits, or any other table of format ``fmt``."""
    return read(spark, path) if is_committed_table(spark, path) else spark.read.format(fmt).load(path)


def _publish(spark: SparkSession, path: str, job: str, manifest: dict) -> bool:
    """Makes the manifest visible; False if the job has one already."""
    jvm = spark.sparkContext._jvm
    fs, folder = _fs(spark, f"{path}/_commits")
    fs.mkdirs(folder)
    draft = jvm.org.apache.hadoop.fs.Path(folder, f".{job}-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(folder, f"{job}.json")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        folder.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(
        jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(files.makeQualified(draft), files.makeQualified(final), no_overwrite)
        return True
    except Exception as e:
        if not fs.exists(final):
            raise
        if "FileAlreadyExists" not in str(e) and "already exists" not in str(e):
            raise
        return False


def commit(df: DataFrame, path: str, job: str, mode: str = "append",
           metrics: dict[str, Column] | None = None) -> dict:
    """Add ``df`` to the table once under the name ``job`` and return its manifest.

    ``mode="overwrite"`` replaces every commit visible now.  ``metrics`` are aggregates
    that are observed during the write; ``rows`` always is.
    """
    if not _JOB.fullmatch(job):
        raise ValueError(f"a job is named by letters, digits and ._=- only, not {job!r}")
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    known = manifests(spark, path)
    if job in known:
        return known[job]
    seen = visible(known)
    schema = json.loads(df.schema.json())
    if mode == "append" and seen:
        same = [(f.name, f.dataType) for f in T.StructType.fromJson(seen[0]["schema"])]
        if same != [(f.name, f.dataType) for f in df.schema]:
            raise ValueError(f"the columns of {path} are {same}")
    figures = {"rows": F.count(F.lit(1))} | (metrics or {})
    watch = Observation(f"commit-{uuid.uuid4().hex}")
    folder = f"data/{job}-{uuid.uuid4().hex}"
    df.observe(watch, *[c.alias(name) for name, c in figures.items()]).write.parquet(
        f"{path}/{folder}")
    manifest = {"job": job, "folder": folder, "schema": schema, "metrics": watch.get,
                "replaces": [m["job"] for m in seen] if mode == "overwrite" else []}
    if _publish(spark, path, job, manifest):
        return manifest
    return manifests(spark, path)[job]                      # another attempt was first


def history(spark: SparkSession, path: str) -> DataFrame:
    """(job, metric, value, visible): the observed figures of every commit."""
    known = manifests(spark, path)
    seen = {m["job"] for m in visible(known)}
    rows = [(job, name, None if v is None else float(v), job in seen)
            for job, m in sorted(known.items()) for name, v in sorted(m["metrics"].items())]
    return spark.createDataFrame(rows, "job string, metric string, value double, visible boolean")
