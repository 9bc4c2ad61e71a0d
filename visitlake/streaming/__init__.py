"""Structured Streaming versions of collection, ETL and upserts."""
