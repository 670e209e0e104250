"""Readers, writers and the data contracts they follow."""
