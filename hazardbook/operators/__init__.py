"""Relational operators that take column names, so that they run on any table."""
