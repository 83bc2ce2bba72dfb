"""Concept extraction from free-text notes, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
