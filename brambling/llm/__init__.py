"""Operators for text corpora and entity records; nothing else in the library imports this subpackage."""
