"""Counts, comparisons and guards over partition keys."""
