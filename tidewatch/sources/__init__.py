"""Contracts, readers and sinks."""
