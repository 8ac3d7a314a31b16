"""Order analytics on Spark: ingest, clean, load, check, roll up and report."""
