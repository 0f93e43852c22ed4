"""Record shaping: delimited parsing, rendering, codecs, equality, framing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.support.rows import PEOPLE
from tidewire import operators as ops
from tidewire.functions.records import registry_frame, same_record

def test_employee_fixture_parse_and_render(spark):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(PEOPLE)], "id string, raw string")
    rec = ops.parse_delimited(df, "raw", "_", ["emp_name", "emp_address"], keep=("id",))
    rows = {r.id: (r.emp_name, r.emp_address) for r in rec.collect()}
    assert rows["0"] == ("Ada", "LND") and rows["8"] == ("Ivo", "PRG") and len(rows) == 9
    text = ops.render_records(rec, "key: %s, val: Employee{Name='%s', Address=%s}",
                              ["id", "emp_name", "emp_address"], keep=("id",))
    assert text.filter("id = '3'").collect()[0].text == "key: 3, val: Employee{Name='Dora', Address=VIE}"


def test_underscore_rule_keeps_trailing_empty(spark):
    df = spark.createDataFrame([("Alex_US",), ("Alex_",), ("Alex_US_x",), ("Alex",)], "raw string")
    out = ops.parse_delimited(df, "raw", "_", ["n", "a"], keep=("raw",), on_bad="null")
    got = {r.raw: (r.n, r.a) for r in out.collect()}
    assert got == {"Alex_US": ("Alex", "US"), "Alex_": ("Alex", ""), "Alex_US_x": ("Alex", "US"),
                   "Alex": (None, None)}
    with pytest.raises(PySparkException):
        ops.parse_delimited(df, "raw", "_", ["n", "a"]).collect()


def test_render_null_prints_null(spark):
    df = spark.createDataFrame([("1", None, "x")], "id string, n string, a string")
    assert ops.render_records(df, "Employee{Name='%s', Address=%s}", ["n", "a"]).collect()[0].text == \
        "Employee{Name='null', Address=x}"


def test_payload_roundtrip(spark):
    df = spark.createDataFrame([("aé",), ("",), (None,), ("aaa",), ("bbb",), ("ccc",)], "str_data_prop string")
    out = ops.payload_roundtrip(df, "str_data_prop").collect()
    assert [r.str_data_prop for r in out] == ["aé", "", None, "aaa", "bbb", "ccc"]
    assert out[0].n_bytes == 3


def test_record_equality_null_safe(spark):
    df = spark.createDataFrame([(None, "x", None, "x"), (None, "x", "n", "x"), ("a", "b", "a", "b")],
                               "n1 string, a1 string, n2 string, a2 string")
    same = [r[0] for r in df.select(same_record(F.struct("n1", "a1"), F.struct("n2", "a2"))).collect()]
    assert same == [True, False, True]


def test_registry_frame_refuses_other_bytes(spark):
    for bad in ("7F0000002A0A48", "00", ""):
        df = spark.createDataFrame([(bytearray.fromhex(bad),)], "value binary")
        with pytest.raises(PySparkException, match="not a registry-framed value"):
            ops.strip_registry_frame(df).collect()


def test_long_key_refuses_other_lengths(spark):
    from tidewire.functions.kv import long_from_bytes
    ok = spark.createDataFrame([(bytearray.fromhex("FFFFFFFFFFFFFFFF"),), (None,)], "k binary")
    assert [r[0] for r in ok.select(long_from_bytes("k")).collect()] == [-1, None]
    with pytest.raises(PySparkException, match="8 bytes"):
        spark.createDataFrame([(bytearray.fromhex("FFFFFFFF"),)], "k binary").select(long_from_bytes("k")).collect()


def test_rendered_counts_are_never_cut(spark):
    from tidewire.functions.records import bracket_join
    df = spark.sql("select array(named_struct('value', 'v', 'n', 2147483649L)) as e")
    with pytest.raises(PySparkException, match="too many equal values"):
        df.select(bracket_join("e")).collect()


def test_registry_frame(spark):
    df = spark.createDataFrame([(42, bytearray.fromhex("0A48"))], "sid int, payload binary")
    framed = df.select(registry_frame("sid", "payload").alias("value"))
    assert framed.select(F.hex("value")).collect()[0][0] == "000000002A0A48"
    parts = ops.strip_registry_frame(framed).collect()[0]
    assert (parts.magic, parts.schema_id, bytes(parts.payload)) == ("00", 42, bytes.fromhex("0A48"))


def test_to_record_schema(spark):
    df = spark.createDataFrame([("IO IT Test line of text. Line seed: 0",)], "row string")
    schema = T.StructType([T.StructField("row", T.StringType(), False)])
    rec = ops.to_record(df, schema)
    assert rec.schema["record"].dataType.fieldNames() == ["row"]
    bad = spark.createDataFrame([(None,)], "row string")
    with pytest.raises(PySparkException):
        ops.to_record(bad, schema).collect()
