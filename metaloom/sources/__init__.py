"""Readers of landed documents, entity tables, tags and metadata."""
