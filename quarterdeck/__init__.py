"""Spark-native regulatory-filings pipeline: index, links, landing pages, documents, lookups."""
