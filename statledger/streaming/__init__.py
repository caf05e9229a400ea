"""Loads triggered by newly landed files."""
