"""Column expressions for key/value records.

All of these are built-in Spark expressions: they run inside whole-stage
codegen and work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.fixed import CSV_SEPARATOR, NULL_TEXT, PREFIX_SEPARATOR, ROUTE_TOPICS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def csv_pair_valid(line) -> Column:
    """True when ``line`` splits into at least two fields on ``,``.

    Java's ``String.split(",")`` drops trailing empty fields, so ``"a,"``
    has one field while ``",b"`` and ``"a,,c"`` have two or more.  That is
    exactly "a comma remains after removing trailing commas".  NULL in,
    NULL out; callers decide how NULL counts.
    """
    return F.rtrim(_c(line), F.lit(CSV_SEPARATOR)).contains(CSV_SEPARATOR)


def csv_field(line, n: int) -> Column:
    """Field ``n`` (1-based) of a comma separated line; empty when absent.

    Fields 1 and 2 are cut with ``substring_index`` (a scan to the n-th
    comma, no array of all fields); the value of a valid line is exactly
    what ``split_part`` gives.
    """
    src = _c(line)
    if n == 1:
        return F.substring_index(src, CSV_SEPARATOR, 1)
    if n == 2:
        sep = CSV_SEPARATOR
        return F.when(src.contains(sep), F.substring_index(F.substring_index(src, sep, 2), sep, -1)) \
            .otherwise(F.lit(""))
    return F.split_part(src, F.lit(CSV_SEPARATOR), F.lit(n))


def delimited_field(raw, sep: str, n: int) -> Column:
    """Field ``n`` (1-based) of ``raw`` cut at ``sep``, trailing empties kept."""
    return F.split_part(_c(raw), F.lit(sep), F.lit(n))


def null_to_literal(col, literal: str = NULL_TEXT) -> Column:
    """Replace NULL by a literal string."""
    return F.coalesce(_c(col), F.lit(literal))


def alternate_topic(seq, even_topic: str = ROUTE_TOPICS[0], odd_topic: str = ROUTE_TOPICS[1]) -> Column:
    """Route by the parity of a stored sequence number (offset).

    Sequence 0 goes to ``even_topic``, 1 to ``odd_topic`` and so on; a
    stored sequence makes the choice reproducible on replay.
    """
    return F.when(F.pmod(_c(seq), F.lit(2)) == 0, F.lit(even_topic)).otherwise(F.lit(odd_topic))


def prefixed(col, prefix: str, sep: str = PREFIX_SEPARATOR) -> Column:
    """``<prefix><sep><value>``."""
    return F.concat(F.lit(prefix), F.lit(sep), _c(col))


def long_from_bytes(col) -> Column:
    """Signed big-endian 8-byte key -> LONG (what a Long deserializer yields);
    a key of any other length fails the job."""
    c = _c(col)
    return F.when(c.isNull() | (F.octet_length(c) == 8), F.conv(F.hex(c), 16, -10).cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("a long key has 8 bytes, not "), F.octet_length(c).cast("string"))))


def long_to_bytes(col) -> Column:
    """LONG -> signed big-endian 8 bytes."""
    return F.unhex(F.lpad(F.hex(_c(col).cast("bigint")), 16, "0"))


def java_text(col) -> Column:
    """Text of a value as Java string concatenation shows it (NULL -> ``null``)."""
    return F.coalesce(_c(col).cast("string"), F.lit(NULL_TEXT))
