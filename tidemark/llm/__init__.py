"""Training-data operators: search, deduplication, scans, scoring, mixing, encoding.

Nothing outside this subpackage imports it; ``llm.queries`` holds its registered queries.
"""
