"""The ingest classification on a streaming source.

The source pipeline is batch only; its row rules are plain column
expressions, so the same operator serves a stream of order files.
"""

from orderlake.streaming.ingest import classify_stream, ingest_batches, start_order_ingest  # noqa: F401
