"""Passenger-manifest ingestion, checking and maintenance as Spark jobs."""
