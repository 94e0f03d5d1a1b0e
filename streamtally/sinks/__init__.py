"""Sinks: lake tables, keyed tables, text files, message logs."""
