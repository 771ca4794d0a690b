"""Expressions with the dialect's exact semantics."""
