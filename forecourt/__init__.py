"""Used-vehicle listings analytics on Spark: ingest, validate, clean, dedup, upsert, marts."""
