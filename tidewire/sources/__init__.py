"""Sources: broker readers, text and sequences, and the replay of
tables as streams in time slices."""

from tidewire.sources.files import sequence, text_lines  # noqa: F401
from tidewire.sources.kafka import kafka_batch, kafka_stream, source_options  # noqa: F401
from tidewire.sources.replay import (  # noqa: F401
    BROKER_SCHEMA,
    as_broker_records,
    read_slices,
    time_slices,
    write_slices,
)
