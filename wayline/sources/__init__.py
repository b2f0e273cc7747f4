"""Reading landed data and publishing tables."""
