"""Runs that chain operators, and the registry of named queries."""
