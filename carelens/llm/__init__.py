"""Training-data operators: scoring, mixing, tokenising, deduplication, search and filters.

Nothing outside this folder imports it. ``queries`` holds the ``opN_`` queries and the
pipeline entry; each operator lives in a module of its own.
"""
