"""Readers, writers, catalog tables, snapshots and generated test input."""
