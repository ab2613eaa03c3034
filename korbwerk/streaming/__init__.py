"""Korbwerk streaming."""
