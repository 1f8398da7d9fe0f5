"""Readers, archive layouts and writers."""
