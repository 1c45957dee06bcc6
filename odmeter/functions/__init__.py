"""Column expressions; all of them stay inside Catalyst."""
