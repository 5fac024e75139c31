"""CSV writers."""
