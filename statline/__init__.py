"""Scouting statistics on Spark: ingest, check, clean, aggregate, search, report."""

__version__ = "0.1.0"
