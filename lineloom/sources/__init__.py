"""sources of the line engine."""
