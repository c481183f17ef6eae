"""Operators that prepare training data; nothing else in the library imports this subpackage."""
