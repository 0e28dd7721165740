"""Batch analytics over monthly text logs, written as plain Spark DataFrame steps."""
