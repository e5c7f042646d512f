"""Streaming form of the log counts (the original work is batch only)."""

from quarry.streaming.logstream import (  # noqa: F401
    start_group_counts,
    stream_group_counts,
    stream_org_counts,
)
