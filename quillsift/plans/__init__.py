"""Composed flows: extract, validate, transform, load, report."""
