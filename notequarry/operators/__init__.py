"""DataFrame operators. Span tables are keyed by (doc_id, part) unless told otherwise."""

KEYS = ("doc_id", "part")
