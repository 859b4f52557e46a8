"""Readers of seeds and pages."""
