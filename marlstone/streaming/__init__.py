"""Results row by row, and queries over streams."""
