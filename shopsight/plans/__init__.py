"""Compositions of operators: the customer plan and the full run."""
