"""Snapshot synchronisation of relational catalogues on Spark."""
