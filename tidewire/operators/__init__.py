"""DataFrame -> DataFrame operators.  Only ``checked_lookup``, ``bucketed_lookup`` and those of
``numbering`` run a Spark action: they write the table they return or number."""

from tidewire.operators.aggs import bracket_list, filter_by_global, global_max, value_counts  # noqa: F401
from tidewire.operators.bounded import bounded_by_count, bounded_by_time  # noqa: F401
from tidewire.operators.joins import (  # noqa: F401
    bucketed_lookup,
    checked_lookup,
    cogroup_counts,
    duplicate_keys,
    format_cogroup,
    lookup_join,
    tag_sides,
    unique_lookup,
    windowed_cogroup,
)
from tidewire.operators.kv import (  # noqa: F401
    decode_kv,
    null_to_literal,
    parse_csv_kv,
    prefix,
    route_alternate,
    text_to_lines,
    values_only,
)
from tidewire.operators.numbering import bracket_parts, dense_numbers, route_dense  # noqa: F401
from tidewire.operators.records import (  # noqa: F401
    decode_avro,
    parse_delimited,
    payload_roundtrip,
    render_records,
    strip_registry_frame,
    to_record,
)
from tidewire.operators.windows import (  # noqa: F401
    assign_event_time,
    event_time_from_policy,
    fixed_window,
    window_counts,
)
