"""End-to-end jobs over stored tables."""
