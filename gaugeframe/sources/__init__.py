"""Readers of landed pages and of the stored observation table."""
