"""operators of the line engine."""
