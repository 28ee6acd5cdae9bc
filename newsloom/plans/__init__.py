"""Whole jobs composed of the operators, and the driver's queries."""
