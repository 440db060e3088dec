"""Layouts and column expressions."""
