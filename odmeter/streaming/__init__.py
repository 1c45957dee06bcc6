"""File arrival as a stream."""
