"""Column-level helpers: names, types, text form, row hashes, word splitting."""
