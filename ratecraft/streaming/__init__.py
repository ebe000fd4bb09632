"""Incremental scoring. The reference has no streaming operators; the only stream-
shaped work is its scoring service, offered here as a file-stream job that applies
the same saved model (M6) to each new parquet file as it lands."""

from ratecraft.streaming.score_stream import score_stream

__all__ = ["score_stream"]
