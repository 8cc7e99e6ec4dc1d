"""Operators for preparing language-model training data; see the README of the repository."""
