"""Readers of snapshots, dictionaries, run summaries, config entries and landed payloads."""
