"""Readers, writers and the order-line view over the source tables."""
