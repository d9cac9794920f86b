"""Views over the base tables and the published query patterns."""
