"""Readers for tables, trade files, book archives and listings."""
