"""The library's operators over the given test tables, each with an equivalent SQL text."""
