"""Sinks: shared tables, line and column files, external tables."""
