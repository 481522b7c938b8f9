"""Deliverable queries composed from the operators."""
