"""Registered queries by theme."""
