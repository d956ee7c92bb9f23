"""Column expressions: one function per signal read from a post."""
