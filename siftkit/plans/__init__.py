"""Composite jobs J1-J8."""
