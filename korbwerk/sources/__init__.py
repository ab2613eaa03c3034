"""Korbwerk sources."""
