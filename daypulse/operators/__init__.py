"""Relational operators: staging, marts, reports, series, quality."""
