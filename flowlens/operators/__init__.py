"""Reusable DataFrame operators (no Python per row)."""
