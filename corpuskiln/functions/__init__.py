"""Column functions over texts."""
