"""Column-level helpers: calendar arithmetic and text."""
