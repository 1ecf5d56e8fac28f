"""Readers and writers: catalogue tables, file listings, log lines."""
