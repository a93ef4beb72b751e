"""Structured Streaming maintenance of derived tables and reports."""
