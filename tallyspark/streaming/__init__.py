"""Micro-batch maintenance of stored models from landed fact files."""

from tallyspark.streaming.microbatch import land_event_files, stream_upsert

__all__ = ["land_event_files", "stream_upsert"]
