"""plans of the line engine."""
