"""The library's own queries and their SQL."""
