"""Compositions: returns, metadata, research table, datasets, trade ingest."""
