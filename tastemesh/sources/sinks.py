"""Sinks (K1-K4): append/overwrite tables, tab-separated text, JSON lines.

Every sink is a distributed DataFrame write: each task writes its own part
file under the target folder, and the commit protocol publishes them only
when the job succeeds, so a lost executor's half-written output is never
visible.  (The reference appended rows to one local file from a ``foreach``,
which on a cluster leaves one partial file per executor.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tastemesh.sources.commits import commit


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                partition_by: list[str] | None = None, job: str | None = None,
                **options) -> None:
    """Append (default, as the reference) or overwrite a collection (K1).

    With a ``job`` name the table is one of commits: the rows count once, however
    often the job runs (:mod:`tastemesh.sources.commits`)."""
    if job is not None:
        if fmt != "parquet" or partition_by or options:
            raise ValueError("commits are plain parquet")
        commit(df, path, job, mode)
        return
    w = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_lines(lines: DataFrame, path: str, mode: str = "append") -> None:
    """One text line per row of a single string column (K2 with ``topical_lines``)."""
    if len(lines.columns) != 1:
        raise ValueError("write_lines needs exactly one string column")
    lines.write.mode(mode).text(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines export of a collection (K3)."""
    df.write.mode(mode).json(path)
