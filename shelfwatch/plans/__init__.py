"""Whole jobs composed of the operators: cleaning, warehouse, analytics, measures."""
