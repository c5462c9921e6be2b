"""Readers, writers and the shop tables derived from the given data."""
