"""Micro-batch ingest of order events."""
