"""Composite reports built from the operators."""
