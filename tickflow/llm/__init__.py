"""Operators for large text corpora used as training data; nothing outside this subpackage imports it."""
