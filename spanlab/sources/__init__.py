"""Readers, writers and the fixture views derived from the driver tables."""
