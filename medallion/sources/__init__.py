"""Reading pages and writing tables."""
