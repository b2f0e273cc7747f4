"""The same steps as streams over arriving files."""
