"""Readers, writers and the role views over the driver's tables."""
