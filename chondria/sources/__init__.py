"""Readers: text tables, coverage tables, call files and tool reports as DataFrames."""
