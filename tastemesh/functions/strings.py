"""String helpers, all built from JVM-side column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_list(c: ColumnOrName, sep: str = ",", trim: bool = True) -> Column:
    """Comma-string → array.

    ``trim=True`` (default) strips spaces around every element, so
    ``"Food, Restaurants"`` yields ``["Food", "Restaurants"]``.  ``trim=False``
    is the literal ``split(s, '[,]')`` behaviour that keeps ``" Restaurants"``.
    """
    parts = F.split(_col(c), "[" + sep + "]")
    if trim:
        parts = F.transform(parts, lambda x: F.trim(x))
    return parts


def null_as_text(c: ColumnOrName) -> Column:
    """Value rendered as text the way string concatenation prints it.

    ``concat_ws`` silently skips nulls, which would shift the columns of a
    tab-separated line; a null prints as the text ``null`` instead (K2).
    """
    return F.coalesce(_col(c).cast("string"), F.lit("null"))


def tab_line(*cols: ColumnOrName) -> Column:
    """One tab-separated line of the given columns, nulls printed as ``null``."""
    return F.concat_ws("\t", *[null_as_text(c) for c in cols])


def join_ids(ids: ColumnOrName, sep: str = " ") -> Column:
    """Array of ids → separator-joined string."""
    return F.array_join(F.transform(_col(ids), lambda x: x.cast("string")), sep)


def parse_id_list(c: ColumnOrName, sep: str = " ") -> Column:
    """Separator-joined id string → array of non-empty ids."""
    return F.filter(F.split(_col(c), "[" + sep + "]"), lambda x: x != F.lit(""))


def field_of_line(c: ColumnOrName, index: int, sep: str = ",") -> Column:
    """``split(line, sep)[index]`` (P8), null when the field is absent."""
    return F.get(F.split(_col(c), "[" + sep + "]"), index)


def set_text(values: ColumnOrName) -> Column:
    """A set printed as ``[a, b, c]`` (X9): sorted, comma-space separated.

    Only for bounded arrays (e.g. a user's top-k set).
    """
    return F.concat(F.lit("["), F.array_join(F.sort_array(F.array_distinct(_col(values))), ", "),
                    F.lit("]"))
