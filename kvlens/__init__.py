"""Keyspace analytics on Spark."""
