"""Values read off their JSON text, and records extended as text, are what the VARIANT functions give."""

import pytest
from pyspark.sql import functions as F

from salespark.functions import json as J

VALUES = ["null", "true", "0", "-0", "7", "-12", "2147483647", "2147483648", "9223372036854775807", "9223372036854775808",
          "123456789012345678901234567890", "1.5", "-0.005", "0.125", "2.50", "2.00", "1.99999999999999999999", "12345678901.5",
          "99999999999999999999.995", "1e3", "1.5E-3", "1e30", "-2147483648.0", '""', '"7"', '" 7 "', '"2.5"', '"1e2"', '"x"',
          '"N/A"', r'"a\"b"', r'"a\\b"', r'"\n"', r'"é中"', '"é中😀"', '"a/b"', "{}", '{"a":1}', "[]", '[1,"2"]']
TYPES = ["string", "int", "double", "decimal(10,2)", "decimal(22,2)"]


@pytest.mark.parametrize("as_type", TYPES)
def test_read_is_as_type(spark, as_type):
    rows = spark.createDataFrame([(f'{{"k": {v}}}',) for v in VALUES] + [("{}",), ("no json",), (None,)], "t string")
    e = rows.select("t", J.field(J.parse("t"), "k").alias("v")).select("t", "v", J.text_of(F.col("v")).alias("j"))
    got = e.select("t", J.read(F.col("v"), F.col("j"), as_type).alias("a"), J.as_type(F.col("v"), as_type).alias("b")).collect()
    assert len(got) == len(VALUES) + 3
    assert [(r.t, r.a) for r in got] == [(r.t, r.b) for r in got]


def test_total_by_way_of_the_wider_type(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "t string").select(J.parse("t").alias("v"))
    got = rows.select(J.as_type(F.col("v"), "decimal(22,2)").try_cast("decimal(12,2)").alias("a"),
                      J.as_type(F.col("v"), "decimal(12,2)").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_extend_is_merge(spark):
    """Unknown keys, new keys that are there already, nested ones, escapes, no keys at all, and null new values."""
    texts = ["{}", '{"z": 1, "b": "x", "é": 2.50}', '{"day": "old", "a": 1}', '{"n": {"day": 1}, "l": [1, {"hour": 2}]}', r'{"a\"b": "c\\d"}',
             '{"t": "\\"day\\":"}', '{"hour": null, "e": 1e3}', r'{"c": "\u0001"}', '{"a": null, "A": true}']
    rows = spark.createDataFrame([(t, d, h) for t in texts for d, h in (("Monday", 3), (None, None), ('a"b', -1))], "t string, day string, hour int")
    e = rows.select("*", J.parse("t").alias("v")).select("*", J.text_of(F.col("v")).alias("j"))
    merged = J.merge(J.as_map("v"), J.struct_as_map(F.col("hour"), F.col("day")), ["hour", "day"])
    got = e.select(J.extend(F.col("j"), "v", {"hour": F.col("hour"), "day": F.col("day")},
                            J.has_key("v", "hour") | J.has_key("v", "day")).alias("a"), J.write(merged).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
