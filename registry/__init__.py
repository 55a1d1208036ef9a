"""The registered queries: inputs derived from the given tables, and the same results in SQL."""
