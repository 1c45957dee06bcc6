"""Counts and statistics about data and runs."""
