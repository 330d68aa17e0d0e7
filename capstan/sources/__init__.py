"""Readers: spool folders, archive files, capture indexes, item metadata."""
