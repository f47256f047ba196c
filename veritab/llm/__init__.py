"""Operators for building training corpora from the ``documents`` family of
tables. Nothing else in the library imports this subpackage."""
