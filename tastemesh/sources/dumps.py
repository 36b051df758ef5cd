"""Collection dumps in extended JSON (S4, K3): one document a line, values with typed wrappers.

Plain JSON has no 64-bit integers, dates, decimals, binaries or object ids; a dump
wraps them (``{"$numberLong": "9007199254740993"}``).  :func:`read_dump` reads
lines into the columns of a schema and keeps apart every line that it can't
read whole; :func:`dump_lines` writes a table so that it comes back unchanged.
Both are column expressions: a line is parsed once, into a variant, and every
file is split by Spark's text reader.

Per type, the value is taken from its wrapper, or from the plain JSON value:

    string      "$oid", or a string, number or boolean as its text
    int, long   "$numberInt", "$numberLong"
    double      "$numberDouble" (NaN, Infinity and -Infinity too)
    decimal     "$numberDecimal"
    timestamp   "$date": milliseconds in "$numberLong", plain milliseconds, or ISO text
    binary      "$binary": {"base64": ..., "subType": ...}
    array, map, struct: of these

Defined cases: a missing field and a JSON null are null; blank lines are no
documents; fields outside the schema are left out; a line that is no JSON, no
object, has a field twice, or holds a value that does not fit its column's type goes to the
quarantine with the reason.  Timestamps keep milliseconds (later digits are cut).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.DecimalType,
          T.TimestampType, T.BinaryType)


def _at(value: Column, key: str, as_type: str) -> Column:
    """A member of a variant object, null if it is missing or of another type."""
    return F.try_variant_get(value, f"$[{json.dumps(key)}]", as_type)


def _whole(value: Column, as_type: str) -> Column:
    return F.try_variant_get(value, "$", as_type)


def _kind(value: Column) -> Column:
    """The type of a variant, as ``BIGINT``, ``STRING``, ``OBJECT<...>`` and so on."""
    return F.schema_of_variant(value)


def _scalar(value: Column, wrapper: str, sql_type: str, plain: tuple[str, ...]) -> Column:
    """The wrapped value, or the plain one if it is of the ``plain`` kinds."""
    fits = F.lit(False)
    for kind in plain:
        fits = fits | _kind(value).startswith(kind)
    return F.coalesce(_at(value, wrapper, "string").try_cast(sql_type),
                      F.when(fits, _whole(value, sql_type)))


def _typed(value: Column, data_type: T.DataType) -> Column:
    """The value of a variant as ``data_type``, null if it does not fit."""
    if isinstance(data_type, T.StringType):
        kind = _kind(value)
        return F.coalesce(_at(value, "$oid", "string"),
                          F.when(~(kind.startswith("OBJECT") | kind.startswith("ARRAY")),
                                 _whole(value, "string")))
    if isinstance(data_type, T.BooleanType):
        return F.when(_kind(value) == "BOOLEAN", _whole(value, "boolean"))
    if isinstance(data_type, T.IntegerType):
        return F.coalesce(_scalar(value, "$numberInt", "int", ("BIGINT",)),
                          _at(value, "$numberLong", "string").try_cast("int"))
    if isinstance(data_type, T.LongType):
        return F.coalesce(_scalar(value, "$numberLong", "bigint", ("BIGINT",)),
                          _at(value, "$numberInt", "string").try_cast("bigint"))
    if isinstance(data_type, T.DoubleType):
        number = F.coalesce(*[_at(value, w, "string").try_cast("double")
                              for w in ("$numberInt", "$numberLong")])
        return F.coalesce(_scalar(value, "$numberDouble", "double",
                                  ("BIGINT", "DECIMAL", "DOUBLE")), number)
    if isinstance(data_type, T.DecimalType):
        return _scalar(value, "$numberDecimal", data_type.simpleString(), ("BIGINT", "DECIMAL"))
    if isinstance(data_type, T.TimestampType):
        date = _at(value, "$date", "variant")
        text = F.when(_kind(date) == "STRING", _whole(date, "string"))
        millis = F.coalesce(_at(date, "$numberLong", "string").try_cast("bigint"),
                            F.when(_kind(date) == "BIGINT", _whole(date, "bigint")))
        return F.coalesce(F.timestamp_millis(millis), text.try_cast("timestamp"))
    if isinstance(data_type, T.BinaryType):
        return F.try_to_binary(_at(_at(value, "$binary", "variant"), "base64", "string"),
                               F.lit("base64"))
    if isinstance(data_type, T.ArrayType):
        return F.transform(_whole(value, "array<variant>"),
                           lambda x: _present(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        return F.transform_values(_whole(value, "map<string,variant>"),
                                  lambda _, x: _present(x, data_type.valueType))
    if isinstance(data_type, T.StructType):
        fields = [_present(_at(value, f.name, "variant"), f.dataType).alias(f.name)
                  for f in data_type]
        return F.when(_kind(value).startswith("OBJECT"), F.struct(*fields))
    raise TypeError(f"no extended JSON form of {data_type.simpleString()}")


def _absent(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _present(value: Column, data_type: T.DataType) -> Column:
    return F.when(~_absent(value), _typed(value, data_type))


def _misfit(value: Column, data_type: T.DataType, typed: Column | None = None) -> Column:
    """Whether a value is there that does not fit, at any depth; ``typed`` is the value as its
    type, if it is known already."""
    inside = F.lit(False)
    if isinstance(data_type, T.ArrayType):
        inside = F.exists(_whole(value, "array<variant>"),
                          lambda x: _misfit(x, data_type.elementType))
    elif isinstance(data_type, T.MapType):
        inside = F.exists(F.map_values(_whole(value, "map<string,variant>")),
                          lambda x: _misfit(x, data_type.valueType))
    elif isinstance(data_type, T.StructType):
        for f in data_type:
            inside = inside | _misfit(_at(value, f.name, "variant"), f.dataType)
    if typed is None:
        typed = _typed(value, data_type)
    bad = typed.isNull() | F.coalesce(inside, F.lit(False))
    return F.when(_absent(value), F.lit(False)).otherwise(bad)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(line, reason, row): ``row`` is the document of each line of the string column ``line``;
    ``reason`` tells why there is none, and is null if it is whole.

    The results leave a generator of one row: a filter on ``reason`` stays above it, instead of
    being pushed to the scan with a parse of the line for every member that it looks at.
    """
    doc = F.col("doc")
    parsed = (lines.select("line").filter(~F.col("line").rlike(r"^[ \t\r\n]*$"))
              .withColumn("doc", F.try_parse_json("line")))
    # each member is looked up once, and typed once
    members = parsed.select("line", "doc", *[
        _at(doc, f.name, "variant").alias(f"_v{i}") for i, f in enumerate(schema)])
    typed = members.select("line", "doc", *[F.col(f"_v{i}") for i in range(len(schema))], *[
        _present(F.col(f"_v{i}"), f.dataType).alias(f"_t{i}") for i, f in enumerate(schema)])
    misfits = F.concat_ws(", ", *[
        F.when(_misfit(F.col(f"_v{i}"), f.dataType, F.col(f"_t{i}")), F.lit(f.name))
        for i, f in enumerate(schema)])
    named = (F.when(doc.isNull(), F.lit("no JSON"))
             .when(~_kind(doc).startswith("OBJECT"), F.lit("no object"))
             .when(misfits != "", F.concat(F.lit("type of "), misfits)))
    row = F.struct(*[F.col(f"_t{i}").alias(f.name) for i, f in enumerate(schema)])
    return (typed.select("line", F.explode(F.array(F.struct(named.alias("reason"),
                                                            row.alias("row")))).alias("_r"))
            .select("line", "_r.reason", F.when(F.col("_r.reason").isNull(), F.col("_r.row"))
                    .alias("row")))


def read_dump(spark: SparkSession, path: str, schema: T.StructType,
              ) -> tuple[DataFrame, DataFrame]:
    """(documents, quarantine): the columns of ``schema``, and (line, reason) of the lines that
    could not be read whole."""
    both = parse_lines(spark.read.text(path).select(F.col("value").alias("line")), schema)
    documents = both.filter("reason is null").select(
        *[F.col(f"row.`{f.name}`").alias(f.name) for f in schema])
    return documents, both.filter("reason is not null").select("line", "reason")


def _wrapped(value: Column, data_type: T.DataType, oid: bool = False) -> Column:
    """A value with its typed wrapper, as a column that ``to_json`` writes."""
    def as_text(name: str) -> Column:
        return F.struct(value.cast("string").alias(name))
    if oid:
        out = as_text("$oid")
    elif isinstance(data_type, (T.StringType, T.BooleanType)):
        out = value
    elif isinstance(data_type, T.IntegerType):
        out = as_text("$numberInt")
    elif isinstance(data_type, T.LongType):
        out = as_text("$numberLong")
    elif isinstance(data_type, T.DoubleType):
        out = as_text("$numberDouble")
    elif isinstance(data_type, T.DecimalType):
        out = as_text("$numberDecimal")
    elif isinstance(data_type, T.TimestampType):
        millis = F.struct(F.unix_millis(value).cast("string").alias("$numberLong"))
        out = F.struct(millis.alias("$date"))
    elif isinstance(data_type, T.BinaryType):
        body = F.struct(F.base64(value).alias("base64"), F.lit("00").alias("subType"))
        out = F.struct(body.alias("$binary"))
    elif isinstance(data_type, T.ArrayType):
        out = F.transform(value, lambda x: _wrapped(x, data_type.elementType))
    elif isinstance(data_type, T.MapType):
        out = F.transform_values(value, lambda _, x: _wrapped(x, data_type.valueType))
    elif isinstance(data_type, T.StructType):
        out = F.struct(*[_wrapped(value[f.name], f.dataType).alias(f.name) for f in data_type])
    else:
        raise TypeError(f"no extended JSON form of {data_type.simpleString()}")
    return F.when(value.isNotNull(), out)


def dump_lines(df: DataFrame, object_ids: tuple[str, ...] = ()) -> DataFrame:
    """(line): one extended JSON document a row; the string columns of ``object_ids`` become
    object ids."""
    row = F.struct(*[_wrapped(F.col(f"`{f.name}`"), f.dataType, f.name in object_ids)
                     .alias(f.name) for f in df.schema])
    return df.select(F.to_json(row).alias("line"))


def write_dump(df: DataFrame, path: str, object_ids: tuple[str, ...] = (),
               mode: str = "errorifexists") -> None:
    dump_lines(df, object_ids).write.mode(mode).text(path)
