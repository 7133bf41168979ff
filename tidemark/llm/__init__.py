"""Operators for preparing training text, each by one named method; see the README's table."""
