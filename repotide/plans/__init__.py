"""Whole jobs built from the operators, and the questions answered from their tables."""
