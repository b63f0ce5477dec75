"""Tabular quality jobs for delimited exports and tables, as Spark plans."""
