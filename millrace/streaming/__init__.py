"""Stateful event handling."""
