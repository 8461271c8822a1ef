"""Shared column expressions and distributed statistics."""
