"""Scans, sinks, the processed-file ledger and the keyed upsert."""
