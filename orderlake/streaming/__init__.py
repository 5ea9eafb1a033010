"""Incremental (file stream) form of ingestion."""
