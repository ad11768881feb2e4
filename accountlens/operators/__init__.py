"""Reusable DataFrame operators that the jobs in ``plans`` are made of."""
