"""Builds, serving and the showcase queries."""
