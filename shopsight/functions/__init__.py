"""Column-level helpers: exact money, calendar arithmetic, tolerant parsing."""
