"""Writing batches, the manifest that makes them visible, and the ingest jobs."""
