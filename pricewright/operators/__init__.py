"""Operators over the star schema."""
