"""Relational operators: components, deduplication, matching, selection."""
