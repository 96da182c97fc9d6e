"""Whole chains of operators, and the query catalogue."""
