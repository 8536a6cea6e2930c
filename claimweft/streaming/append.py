"""Structured Streaming into an append-only table: each batch adds only rows whose key isn't there yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from claimweft.sources.jsonl import append_new


def append_stream(rows: DataFrame, path: str, key: str, checkpoint: str) -> StreamingQuery:
    """Start a query that appends rows to the JSON-lines table at ``path``; a repeated batch adds nothing."""
    return rows.writeStream.foreachBatch(lambda batch, _: append_new(batch, path, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
