"""Korbwerk operators."""
