"""Readers and the durable store."""
