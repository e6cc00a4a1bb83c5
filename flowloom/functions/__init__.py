"""Column expressions: byte fields, number text and seeded hashes."""
