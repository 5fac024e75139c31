"""Taking in pages as they land."""
