"""Readers. Each returns a lazy DataFrame; listing and reading stay with Spark's own sources."""
