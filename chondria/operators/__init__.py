"""Relational operators over long-form coverage, calls, reads and sample tables."""
