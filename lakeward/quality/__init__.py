"""Declarative data-quality rules, gate and reconciliation."""
