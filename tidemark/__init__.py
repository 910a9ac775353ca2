"""Tidemark: data observability for event streams, built on the Spark DataFrame API."""
