"""Micro-batch loading of landed files (SNK-7)."""
