"""Sinks: broker framing, Kinesis writer, file layouts, replay-safe output."""

from tidewire.sinks.files import (  # noqa: F401
    histogram_write,
    keyed_partition_write,
    topic_files,
    window_dir_column,
    windowed_parquet,
)
from tidewire.sinks.kafka import kafka_frame, kafka_sink, kafka_write, sink_options, topic_sink  # noqa: F401
from tidewire.sinks.kinesis import KinesisSink, kinesis_records  # noqa: F401
from tidewire.sinks.replay_safe import (  # noqa: F401
    batch_writer,
    compact_panes,
    latest_count,
    latest_pane,
    read_batches,
    replay_safe_sink,
)
