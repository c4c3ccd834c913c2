"""Rule tables, as data."""
