"""Readers: the change log, source tables, contracts and bench records."""
