"""Writers of the landing table."""
