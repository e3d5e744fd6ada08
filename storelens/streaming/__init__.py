"""Incremental landing on Structured Streaming.

The source system is batch only (no windows, watermarks or state).  Its
cleaning steps are stateless per row, so the same ``clean_apps`` /
``clean_reviews`` plans run unchanged on a streaming file source: new CSV
drops in a folder are cleaned and appended to the landing table, with
exactly-once bookkeeping in the checkpoint.
"""

from storelens.streaming.landing import stream_landing

__all__ = ["stream_landing"]
