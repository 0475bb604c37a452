"""Operators for cleaning, scoring and mixing training text."""
