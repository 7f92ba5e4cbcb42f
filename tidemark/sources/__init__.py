"""Readers and writers: tables, CSV, the predictions table, JSON lines and metrics."""
