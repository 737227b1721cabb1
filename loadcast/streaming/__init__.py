"""Structured Streaming ingest into the keyed log."""

from loadcast.streaming.ingest import (
    batch_writer,
    file_message_stream,
    kafka_message_stream,
    parse_readings,
    run_for,
    start_ingest,
)

__all__ = ["batch_writer", "file_message_stream", "kafka_message_stream", "parse_readings", "run_for", "start_ingest"]
