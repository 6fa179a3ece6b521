"""Operators put together: stored tables, the mirror's public methods, and the registered queries."""
