"""Operators that work on any DataFrame."""
