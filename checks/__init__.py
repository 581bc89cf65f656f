"""Driver queries on the test tables, and their SQL oracles."""
