"""Korbwerk plans."""
