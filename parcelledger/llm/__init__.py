"""Operators for cleaning and preparing training text; nothing else in the library imports this package."""
