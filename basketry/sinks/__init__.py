"""Writers. Every batch writer overwrites its target, so a re-run after a
lost executor or a failed job converges to the same output."""

from basketry.sinks.writers import (
    publish_events,
    write_csv,
    write_lines,
    write_raw_events,
    write_segments,
)

__all__ = ["publish_events", "write_csv", "write_lines", "write_raw_events", "write_segments"]
