"""Builders of the conformed (Silver) tables and the metric marts (Gold)."""
