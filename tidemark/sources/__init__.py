"""Readers, writers and file-level checks."""
