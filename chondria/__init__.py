"""Mitochondrial cohort analytics as Spark DataFrame transformations."""
