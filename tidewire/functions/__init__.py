"""Column expressions (built-in Spark functions only, no UDFs)."""

from tidewire.functions.kv import (  # noqa: F401
    alternate_topic,
    csv_field,
    csv_pair_valid,
    delimited_field,
    java_text,
    long_from_bytes,
    long_to_bytes,
    null_to_literal,
    prefixed,
)
from tidewire.functions.records import (  # noqa: F401
    bracket_join,
    checked_frame,
    decimal_bytes,
    frame_magic,
    frame_payload,
    frame_schema_id,
    from_payload,
    registry_frame,
    render,
    same_record,
    to_payload,
)
from tidewire.functions.time import epoch_micros, instant_to_ntz, ntz_to_instant  # noqa: F401
