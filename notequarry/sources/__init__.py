"""Readers: note files, keyed parts, dictionaries, lexicons, stored annotations."""
