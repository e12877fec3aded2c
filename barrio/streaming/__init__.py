"""Incremental loads: batch over a file ledger (W1) and Structured Streaming."""
