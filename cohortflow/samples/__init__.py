"""Registered sample queries over the benchmark's star-schema tables, with their SQL counterparts."""
