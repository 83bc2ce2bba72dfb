"""Incremental extraction of a growing notes directory."""
