"""Column expressions for records, payloads and rendered text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.fixed import BRACKET_ITEM, NULL_TEXT, REGISTRY_HEADER_BYTES, REGISTRY_MAGIC_HEX
from tidewire.functions.kv import java_text


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_payload(col, charset: str = "UTF-8") -> Column:
    """Text -> bytes in one fixed charset."""
    return F.encode(_c(col), charset)


def from_payload(col, charset: str = "UTF-8") -> Column:
    """Bytes -> text, reading to the end of the value."""
    return F.decode(_c(col), charset)


def decimal_bytes(col) -> Column:
    """Number -> its decimal text -> UTF-8 bytes."""
    return F.encode(_c(col).cast("string"), "UTF-8")


def same_record(left: Column, right: Column) -> Column:
    """Field-wise record equality where NULL equals NULL.

    Both sides are structs; a missing record (NULL struct) equals only
    another missing record.
    """
    return left.eqNullSafe(right)


def render(template: str, *cols) -> Column:
    """``format_string`` with Java-like ``%s`` rendering (NULL -> ``null``)."""
    return F.format_string(template, *[java_text(c) for c in cols])


# Schema-registry framing: one magic byte, a 4-byte big-endian schema id,
# then the encoded payload (sizes in ``tidewire.fixed``).


def registry_frame(schema_id, payload) -> Column:
    """Build a framed value: magic ``00`` + 4-byte schema id + payload bytes."""
    sid = F.unhex(F.lpad(F.hex(_c(schema_id).cast("int")), 8, "0"))
    return F.concat(F.unhex(F.lit(REGISTRY_MAGIC_HEX)), sid, _c(payload))


def checked_frame(framed) -> Column:
    """The framed value itself; a value shorter than the header or with
    another magic byte fails the job (NULL stays NULL)."""
    c = _c(framed)
    ok = (F.octet_length(c) >= REGISTRY_HEADER_BYTES) & (F.hex(F.substring(c, 1, 1)) == REGISTRY_MAGIC_HEX)
    return F.when(c.isNull() | ok, c).otherwise(F.raise_error(F.concat(
        F.lit("not a registry-framed value: "), F.hex(F.substring(c, 1, REGISTRY_HEADER_BYTES)))).cast("binary"))


def frame_magic(framed) -> Column:
    return F.lower(F.hex(F.substring(checked_frame(framed), 1, 1)))


def frame_schema_id(framed) -> Column:
    return F.conv(F.hex(F.substring(checked_frame(framed), 2, 4)), 16, 10).cast("int")


def frame_payload(framed) -> Column:
    """Bytes after the 5-byte header (what an Avro decoder is given)."""
    return F.substring(checked_frame(framed), REGISTRY_HEADER_BYTES + 1, 2147483647)


#: Longest one-line rendering of a group, in characters; beyond it use ``operators.bracket_parts``.
LINE_LIMIT = 1 << 28


def bracket_join(entries, value_field: str = "value", count_field: str = "n", limit: int = LINE_LIMIT) -> Column:
    """Render an array of ``struct(value, n)`` as ``[v],[v],...``.

    Entries are sorted by value; each value is repeated ``n`` times, which
    lets callers pre-aggregate equal values before the group shuffle.
    NULL values render as ``null``; an empty or NULL array gives ``""``.
    The result is one string per group, so this is a view for small groups: its size is
    counted first, and a line of more than ``limit`` characters fails the job, as does a value
    that is there more often than a line can repeat it; it is never cut.
    """
    ordered = F.array_sort(_c(entries))
    extra = len(BRACKET_ITEM[0]) + len(BRACKET_ITEM[1])
    size = F.aggregate(ordered, F.lit(0).cast("long"), lambda total, e: total + e[count_field] * (
        F.length(F.coalesce(e[value_field].cast("string"), F.lit(NULL_TEXT))) + extra))
    pieces = F.transform(
        ordered,
        lambda e: F.repeat(
            F.concat(F.lit(BRACKET_ITEM[0]), F.coalesce(e[value_field], F.lit(NULL_TEXT)), F.lit(BRACKET_ITEM[1])),
            e[count_field].cast("int"),
        ),
    )
    equal = F.array_max(F.transform(ordered, lambda e: e[count_field]))
    many = F.when(equal > (1 << 31) - 1, F.lit("too many equal values: ")).otherwise(F.lit(""))
    line = F.when(F.coalesce(size, F.lit(0)) <= limit, F.array_join(pieces, "")).otherwise(F.raise_error(F.concat(
        many, F.lit(f"a list is too long for one line of {limit} characters (use bracket_parts): "), size.cast("string"))))
    return F.coalesce(line, F.lit(""))
