"""Operators: the conversion jobs and product similarity."""
