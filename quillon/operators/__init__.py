"""Relational forms of the column encodings."""
