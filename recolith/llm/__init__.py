"""Training-data operators: decontamination, dedup, quality, tokens and archives.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and their DuckDB equivalents.
"""
