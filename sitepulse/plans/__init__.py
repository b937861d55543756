"""Whole analyses composed from the operators, and the query catalogue with its check SQL."""
