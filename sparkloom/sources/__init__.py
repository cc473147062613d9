"""Readers for files, relational tables and message topics."""
