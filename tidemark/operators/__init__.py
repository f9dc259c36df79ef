"""Reusable DataFrame operators; no domain column names."""
