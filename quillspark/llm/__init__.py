"""Training-data operators: mixing, near duplicates, surrogates, token files,
archives, vector search, language, quality, adaptive rules and packing.

Nothing outside this package imports it. ``queries`` holds the registered
queries and their SQL.
"""
