"""Operators that large training-data pipelines need; nothing outside this subpackage imports it."""
