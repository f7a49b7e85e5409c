"""Structured Streaming: incremental, exactly-once ingest of a landing
folder (``ingest.ingest_stream``)."""
