"""File-arrival ingest."""
