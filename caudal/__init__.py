"""Caudal: a batch lakehouse for retail banking data, written as plain Spark DataFrame code."""
