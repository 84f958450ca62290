"""Readers: text, CSV, tables, message streams."""
