"""Operators for building training corpora. Nothing else in waymark imports this package."""
