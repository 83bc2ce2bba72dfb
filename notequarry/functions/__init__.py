"""Column functions: text clean-up, keys, codes, categories and time values."""
