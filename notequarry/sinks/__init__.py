"""Writers: packed parts, delimited text, result tables, annotations, corpora."""
