"""Operators on whole tables."""
