"""Column expressions: hashing, masks, text and time repair."""
