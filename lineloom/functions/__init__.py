"""functions of the line engine."""
