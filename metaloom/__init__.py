"""Catalog metadata as tables: inventories, tags, merges and statements on Spark."""
