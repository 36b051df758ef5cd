"""Table scans (S1, S2, S4) with a pluggable Spark data source.

A collection is a named table under a root (a directory per table for file
formats, or a collection name for a connector format).  The reader is plain
``spark.read.format(fmt)``: any data source on the classpath works (parquet,
json, orc, or a document-store connector), and Catalyst pushes column pruning
and filters into it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tastemesh import schema as S
from tastemesh.sources import commits


@dataclass
class Catalog:
    """Named collections under one root, read through one data source."""

    spark: SparkSession
    root: str
    fmt: str = "parquet"
    options: dict = field(default_factory=dict)
    # per-table option overrides, e.g. {"review": {"collection": "review"}}
    table_options: dict = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)
    suffix: str = ""  # e.g. ".parquet" for roots that hold files of that name

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}{self.suffix}"

    def load(self, name: str) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options)
        reader = reader.options(**self.table_options.get(name, {}))
        schema = self.schemas.get(name)
        if schema is not None:
            reader = reader.schema(schema)
        if "collection" in self.table_options.get(name, {}):
            return reader.load()
        if self.fmt == "parquet" and commits.is_committed_table(self.spark, self.path(name)):
            return commits.read(self.spark, self.path(name))
        return reader.load(self.path(name))


def read_json_lines(spark: SparkSession, path: str,
                    schema: T.StructType | None = None) -> DataFrame:
    """Import of JSON-lines documents (S4) with an explicit schema.

    Schema inference costs a full extra pass over the input; the known
    collections always pass their schema.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_collection_json(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one of the three known collections from JSON lines."""
    return read_json_lines(spark, path, S.SCHEMAS[name])
