import datetime
import decimal
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemesh import schema as S
from tastemesh.sources import dumps

EVERY = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("s", T.StringType()),
    T.StructField("b", T.BooleanType()), T.StructField("i", T.IntegerType()),
    T.StructField("l", T.LongType()), T.StructField("d", T.DoubleType()),
    T.StructField("dec", T.DecimalType(20, 4)), T.StructField("t", T.TimestampType()),
    T.StructField("bin", T.BinaryType()), T.StructField("a", T.ArrayType(T.LongType())),
    T.StructField("m", T.MapType(T.StringType(), T.StringType())),
    T.StructField("o", T.StructType([T.StructField("x", T.LongType()),
                                     T.StructField("$y z", T.DoubleType())]))])


def _parse(spark, lines, schema):
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    return {r.line: (r.reason, r.row) for r in dumps.parse_lines(df, schema).collect()}


def test_every_type_survives_a_round_trip(spark, tmp_path):
    when = datetime.datetime(2018, 1, 2, 3, 4, 5, 678000)
    data = [("5a", "text \"q\" \n ü", True, -7, 9007199254740993, 0.1, decimal.Decimal("1.2500"), when,
             bytearray(b"\x00\xff"), [1, None, -(2**63)], {"k": "v", "n": None}, (2**62, 1e300)),
            (None,) * 12,
            ("5b", "", False, 2**31 - 1, 0, float("inf"), decimal.Decimal("-9999999999999999.9999"),
             datetime.datetime(1901, 2, 3), bytearray(b""), [], {}, (None, float("-inf")))]
    df = spark.createDataFrame(data, EVERY)
    path = str(tmp_path / "dump")
    dumps.write_dump(df, path, object_ids=("_id",))
    back, broken = dumps.read_dump(spark, path, EVERY)
    assert broken.count() == 0
    key = lambda r: r["_id"] or ""
    assert sorted(back.collect(), key=key) == sorted(df.collect(), key=key)
    first = [json.loads(x.value) for x in spark.read.text(path).collect() if '"5a"' in x.value][0]
    assert first["_id"] == {"$oid": "5a"} and first["l"] == {"$numberLong": "9007199254740993"}
    nan = dumps.parse_lines(dumps.dump_lines(spark.sql("SELECT double('NaN') AS d")),
                            T.StructType([EVERY["d"]])).first()
    assert nan.row.d != nan.row.d


def test_plain_values_and_wrappers_are_read_alike(spark):
    schema = T.StructType([EVERY["i"], EVERY["l"], EVERY["d"], EVERY["t"]])
    same = ['{"i": 5, "l": 6, "d": 7, "t": {"$date": 1000}}',
            '{"i": {"$numberInt": "5"}, "l": {"$numberInt": "6"}, "d": {"$numberInt": "7"}, '
            '"t": {"$date": "1970-01-01T00:00:01Z"}, "extra": {"$oid": "1"}}',
            '{"i": {"$numberLong": "5"}, "l": {"$numberLong": "6"}, "d": {"$numberDouble": "7.0"}, '
            '"t": {"$date": {"$numberLong": "1000"}}}']
    got = _parse(spark, same, schema)
    assert {reason for reason, _ in got.values()} == {None}
    assert len({tuple(row) for _, row in got.values()}) == 1


def test_broken_lines_are_kept_apart(spark):
    schema = T.StructType([EVERY["s"], EVERY["l"], EVERY["a"], EVERY["o"]])
    long_text = "x" * 3_000_000
    want = {
        '{"s": "cut off': "no JSON", "[1, 2]": "no object", '"text"': "no object", "null": "no object",
        '{"l": 1, "l": 2}': "no JSON", '{"l": {"$numberLong": "many"}}': "type of l",
        '{"l": "6", "a": 3}': "type of l, a", '{"a": [1, {"$numberLong": "x"}]}': "type of a",
        '{"o": {"x": true}}': "type of o", '{"s": {"deep": 1}, "o": []}': "type of s, o",
        '{"l": 9223372036854775808}': "type of l",
        "{}": None, '{"s": null, "a": [null]}': None,
        json.dumps({"s": long_text}): None}
    got = _parse(spark, [*want, "", " \t"], schema)
    assert {line: reason for line, (reason, _) in got.items()} == want
    assert got[json.dumps({"s": long_text})][1].s == long_text
    assert all((row is None) == (reason is not None) for reason, row in got.values())


def test_the_three_collections(spark, tmp_path):
    for name, schema in S.SCHEMAS.items():
        some = spark.createDataFrame([tuple(
            {T.StringType: "a", T.DoubleType: 1.5, T.LongType: 2**53 + 1, T.IntegerType: 3,
             T.MapType: {"k": "v"}}[type(f.dataType)] for f in schema)], schema)
        dumps.write_dump(some, str(tmp_path / name))
        with open(tmp_path / name / "broken.txt", "w") as f:
            f.write('{"business_id": \n')
        back, broken = dumps.read_dump(spark, str(tmp_path / name), schema)
        assert back.collect() == some.collect()
        assert [r.reason for r in broken.collect()] == ["no JSON"]
        assert dumps.read_dump(spark, str(tmp_path / name), schema)[0].select(
            F.count("*")).first()[0] == 1


def test_a_line_is_parsed_once_whatever_the_filter(spark, tmp_path):
    """The filter on the reason must not carry its own parses of the line to the scan."""
    schema = T.StructType([EVERY["s"], EVERY["l"], EVERY["d"], EVERY["a"]])
    dumps.write_dump(spark.createDataFrame([("x", 1, 2.0, [3])], schema), str(tmp_path / "d"))
    for df in dumps.read_dump(spark, str(tmp_path / "d"), schema):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("parsejson") == 1
