"""Keyed lookups (S10, J8): a set of keys against a table, as joins.

The reference looks records up one key at a time from a request thread; here
any number of keys is one join, so a batch of lookups costs one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``table`` whose ``on`` appears in ``keys`` (each row once)."""
    return table.join(keys.select(on), on, "left_semi")


def attach(rows: DataFrame, table: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Inner-join ``columns`` of ``table`` onto ``rows`` (a missing key drops the row)."""
    return rows.join(table.select(on, *columns), on)
