"""Spark jobs that resolve accounts, contacts and their pages into clean tables."""
