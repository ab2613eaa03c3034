"""Korbwerk functions."""
