"""Composite views and the registered queries."""
