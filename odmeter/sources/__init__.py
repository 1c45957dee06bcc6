"""Readers for month directories, the landing table and run logs."""
