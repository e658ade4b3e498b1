"""Readers and writers for dated tables, JSON docs, text rows and logs."""
