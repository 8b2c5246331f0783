"""Whole loads, put together from the other modules."""
