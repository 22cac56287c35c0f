"""Composite jobs built from sources and operators."""
