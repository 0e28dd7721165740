"""Readers and writers: log files, lake zones, operational tables."""
