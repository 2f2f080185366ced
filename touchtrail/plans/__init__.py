"""The operators put together: the whole chain, and the full rebuild."""
