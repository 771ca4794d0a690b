"""Readers, landing operators and connectors."""
