"""Operators for preparing training data from text tables."""
