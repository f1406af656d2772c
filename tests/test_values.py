"""Tagged values: one case per input type, as in the reference's value tests plus edge cases."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.functions.values import PAYLOAD_FIELDS, VALUE_TYPE, value_struct


def encode(spark, value, dtype, as_json=False):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("x", dtype, True)]))
    out = df.select(value_struct(F.col("x"), dtype, as_json=as_json).alias("v"))
    assert out.schema["v"].dataType.simpleString() == VALUE_TYPE.simpleString()
    return out.first()["v"].asDict(recursive=False)


def only(payloads, name):
    return {k: v for k, v in payloads.items() if k != "type" and v is not None} == (
        {} if name is None else {name: payloads[name]}
    )


@pytest.mark.parametrize(
    "value,dtype,tag,expected",
    [
        (10, T.LongType(), "long", 10),
        (10, T.IntegerType(), "long", 10),
        (10.0, T.DoubleType(), "double", 10.0),
        (False, T.BooleanType(), "bool", False),
        ("10.0", T.StringType(), "string", "10.0"),
    ],
)
def test_atomic(spark, value, dtype, tag, expected):
    v = encode(spark, value, dtype)
    assert v["type"] == tag
    assert v[tag] == expected
    assert only(v, tag)


def test_vec_long(spark):
    v = encode(spark, [10, 12, 13], T.ArrayType(T.LongType(), False))
    assert v["type"] == "vec_long" and v["vec_long"] == [10, 12, 13] and only(v, "vec_long")


def test_map_long(spark):
    v = encode(spark, {"10": 10}, T.MapType(T.StringType(), T.LongType(), False))
    assert v["type"] == "map_long" and v["map_long"] == {"10": 10} and only(v, "map_long")


def test_json_serialised(spark):
    dtype = T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.ArrayType(T.LongType())),
        T.StructField("c", T.BooleanType()),
    ])
    v = encode(spark, (1, [1, 2, 3], False), dtype, as_json=True)
    assert v["type"] == "json"
    assert v["string"] == '{"a":1,"b":[1,2,3],"c":false}'
    assert only(v, "string")


def test_null_keeps_static_tag(spark):
    assert encode(spark, None, T.LongType())["type"] == "long"
    v = encode(spark, None, T.ArrayType(T.DoubleType()))
    assert v["type"] == "vec_double" and only(v, None)
    v = encode(spark, None, T.MapType(T.StringType(), T.StringType()))
    assert v["type"] == "map_string" and only(v, None)
    v = encode(spark, None, T.DecimalType(10, 2))
    assert v["type"] == "double" and only(v, None)


def test_decimals(spark):
    v = encode(spark, Decimal("12.00"), T.DecimalType(10, 2))
    assert v["type"] == "long" and v["long"] == 12 and only(v, "long")
    v = encode(spark, Decimal("12.50"), T.DecimalType(10, 2))
    assert v["type"] == "double" and v["double"] == 12.5 and only(v, "double")
    v = encode(spark, Decimal(7), T.DecimalType(18, 0))
    assert v["type"] == "long" and v["long"] == 7
    big = Decimal("123456789012345678901234567890")
    v = encode(spark, big, T.DecimalType(38, 0))
    assert v["type"] == "double" and v["double"] == float(big)


def test_array_with_null_becomes_json_texts(spark):
    v = encode(spark, [1, None], T.ArrayType(T.LongType(), True))
    assert v["type"] == "vec_string" and v["vec_string"] == ["1", "null"] and only(v, "vec_string")
    v = encode(spark, ["a", None], T.ArrayType(T.StringType(), True))
    assert v["type"] == "vec_string" and v["vec_string"] == ['"a"', "null"]
    v = encode(spark, ["a", "b"], T.ArrayType(T.StringType(), True))
    assert v["vec_string"] == ["a", "b"]


def test_empty_collections(spark):
    v = encode(spark, [], T.ArrayType(T.LongType(), True))
    assert v["type"] == "vec_string" and v["vec_string"] == [] and only(v, "vec_string")
    v = encode(spark, {}, T.MapType(T.StringType(), T.DoubleType(), True))
    assert v["type"] == "map_string" and v["map_string"] == {} and only(v, "map_string")


def test_map_with_null_value(spark):
    v = encode(spark, {"a": 1.5, "b": None}, T.MapType(T.StringType(), T.DoubleType(), True))
    assert v["type"] == "map_string" and v["map_string"] == {"a": "1.5", "b": "null"}


def test_map_with_int_keys_and_nested_values(spark):
    v = encode(spark, {1: [1, 2]}, T.MapType(T.IntegerType(), T.ArrayType(T.LongType())))
    assert v["type"] == "map_string" and v["map_string"] == {"1": "[1,2]"}


def test_struct_and_nested_arrays_are_json(spark):
    v = encode(spark, (1, "x"), T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]))
    assert v["type"] == "json" and v["string"] == '{"a":1,"b":"x"}'
    v = encode(spark, [[1, 2], [3]], T.ArrayType(T.ArrayType(T.LongType())))
    assert v["type"] == "vec_string" and v["vec_string"] == ["[1,2]", "[3]"]


def test_timestamp_as_text(spark):
    import datetime as dt

    v = encode(spark, dt.datetime(2020, 3, 25, 1, 0), T.TimestampNTZType())
    assert v["type"] == "string" and v["string"] == "2020-03-25 01:00:00"


def test_binary_rejected_at_plan_time(spark):
    with pytest.raises(TypeError):
        value_struct(F.col("x"), T.BinaryType())


def test_payload_field_order():
    assert VALUE_TYPE.names == ["type", *PAYLOAD_FIELDS]
    assert PAYLOAD_FIELDS == (
        "long", "double", "bool", "string", "vec_long", "vec_double", "vec_bool", "vec_string",
        "map_long", "map_double", "map_bool", "map_string",
    )
