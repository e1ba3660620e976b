"""Relational operators: search, facets, pickers, dimensions, upserts, batches, history."""
