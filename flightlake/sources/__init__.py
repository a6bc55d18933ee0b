"""Readers and writers for the lake layers."""

from flightlake.sources.inline import airports_frame, cities_frame, rows_frame  # noqa: F401
from flightlake.sources.readers import (  # noqa: F401
    bronze_from_snapshots,
    read_layer,
    read_snapshots,
    read_stored,
    read_tables,
    snapshot_states,
    with_source_file,
    with_source_folder,
)
from flightlake.sources.sinks import write_append, write_overwrite  # noqa: F401
