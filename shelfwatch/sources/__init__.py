"""Readers and writers: CSV files, catalog tables, crawled pages, the retail test tables."""
