"""Readers and writers: delimited files, history tables, control tables."""
