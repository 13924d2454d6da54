"""Puts the repository root on the path."""
