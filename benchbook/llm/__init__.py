"""Training-corpus operators: dedup, packing, tokenizing, sharding, scans, archives, fingerprints, language.

Nothing else in the package imports this subpackage. Every operator takes DataFrames and returns a
DataFrame; columns are picked by name, so extra columns (also such that clash with names used here)
don't matter.
"""
