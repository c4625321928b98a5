"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; the package can be
deleted without touching the rest.
"""
