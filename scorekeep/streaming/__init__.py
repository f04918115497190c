"""Incremental scoring of answer files as they arrive (Structured Streaming).

The original job is batch only; this applies the same scoring (E1) to new
answer files with stream-static joins, so answers loaded after a run are
scored without re-reading the whole fact.  There is no streaming state:
each answer row is scored from the static dimensions alone.
"""
