"""Registered demonstration queries over the driver tables."""
