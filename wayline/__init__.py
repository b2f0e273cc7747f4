"""Wayline: incremental place-data ETL and mention-trend analytics as Spark jobs."""

__version__ = "0.1.0"
