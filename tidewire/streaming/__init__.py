"""Structured Streaming: windowed panes, stream joins, runners."""

from tidewire.streaming.joins import (  # noqa: F401
    bounded_side_counts,
    merged_cogroup,
    stream_lookup_join,
    stream_side_counts,
    stream_stream_cogroup,
)
from tidewire.streaming.runner import (  # noqa: F401
    batches_run,
    rows_dropped_by_watermark,
    run_available,
    run_early,
    run_final,
    run_timers,
    start_early,
)
from tidewire.streaming.windows import stream_window_counts  # noqa: F401
