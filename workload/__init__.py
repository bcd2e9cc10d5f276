"""The library's operators over the given tables, each with an independent SQL text."""
