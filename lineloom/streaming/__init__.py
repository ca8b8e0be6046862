"""streaming of the line engine."""
