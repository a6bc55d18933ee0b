"""Incremental raw -> silver with Structured Streaming."""

from flightlake.streaming.incremental import (  # noqa: F401
    append_silver_batches,
    dedupe_stream,
    run_available_now,
    run_exact_available_now,
    silver_rows_stream,
)
