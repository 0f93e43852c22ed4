"""Record shaping: delimited parsing, fixed-schema records, rendering,
payload codecs, record equality and registry-framed values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.kv import delimited_field
from tidewire.functions.records import (
    frame_magic,
    frame_payload,
    frame_schema_id,
    from_payload,
    render,
    to_payload,
)


def parse_delimited(df: DataFrame, col: str, sep: str, fields: list[str],
                    keep: tuple[str, ...] = (), on_bad: str = "fail") -> DataFrame:
    """Cut ``col`` at ``sep`` into ``fields`` (trailing empty fields kept).

    A value with fewer than ``len(fields)`` parts is handled by ``on_bad``:
    ``'fail'`` raises, ``'drop'`` filters it out, ``'null'`` leaves NULLs.
    """
    src = F.col(col)
    need = len(fields) - 1
    if not sep:
        raise ValueError("separator must not be empty")
    # number of separators = removed characters / separator length
    n_seps = (F.length(src) - F.length(F.replace(src, F.lit(sep), F.lit("")))) / len(sep)
    valid = F.coalesce(n_seps >= need, F.lit(False))
    outs = []
    for i, name in enumerate(fields, start=1):
        v = delimited_field(src, sep, i)
        if on_bad == "fail":
            v = F.when(valid, v).otherwise(F.raise_error(F.concat(
                F.lit(f"expected {len(fields)} fields separated by '{sep}': "),
                F.coalesce(src, F.lit("null")))))
        elif on_bad == "null":
            v = F.when(valid, v)
        outs.append(v.alias(name))
    out = df
    if on_bad == "drop":
        out = df.filter(valid)
    return out.select(*keep, *outs)


def to_record(df: DataFrame, schema: T.StructType, out: str = "record",
              keep: tuple[str, ...] = ()) -> DataFrame:
    """Wrap columns as one struct with a fixed schema (names and types).

    Columns are cast to the schema's types; a non-nullable field that is
    NULL fails the row.
    """
    fields = []
    for f in schema.fields:
        c = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            c = F.when(c.isNotNull(), c).otherwise(
                F.raise_error(F.lit(f"field {f.name} must not be null")))
        fields.append(c.alias(f.name))
    return df.select(*keep, F.struct(*fields).alias(out))


def render_records(df: DataFrame, template: str, cols: list[str], out: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Render rows as text with a ``%s`` template (NULL prints ``null``)."""
    return df.select(*keep, render(template, *cols).alias(out))


def payload_roundtrip(df: DataFrame, col: str, charset: str = "UTF-8",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Text -> bytes -> text; exposes the byte length and a digest of the
    bytes so that the encoding can be checked without moving the bytes."""
    payload = to_payload(col, charset)
    return df.select(*keep,
                     F.octet_length(payload).alias("n_bytes"),
                     F.sha2(payload, 256).alias("payload_sha256"),
                     from_payload(payload, charset).alias(col))


def strip_registry_frame(df: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Split registry-framed bytes into ``magic``, ``schema_id``, ``payload``."""
    return df.select(*keep,
                     frame_magic(col).alias("magic"),
                     frame_schema_id(col).alias("schema_id"),
                     frame_payload(col).alias("payload"))


def decode_avro(df: DataFrame, col: str, schema_json: str, out: str = "record") -> DataFrame:
    """Decode Avro payloads (after ``strip_registry_frame``) with a given
    writer schema.  Needs the ``spark-avro`` package on the classpath."""
    from pyspark.sql.avro.functions import from_avro
    return df.withColumn(out, from_avro(F.col(col), schema_json))
