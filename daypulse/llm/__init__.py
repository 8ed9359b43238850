"""Corpus operators for training data: mixing, scanning, extraction, deduplication, formatting.

Nothing outside this package imports it. Each operator module has a general
``DataFrame -> DataFrame`` interface; :mod:`daypulse.llm.queries` holds the thin
registered queries and their DuckDB oracles.
"""
