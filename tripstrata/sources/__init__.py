"""Readers, writers, table layout, test-table adapters and synthetic trips."""
