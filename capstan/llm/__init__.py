"""Operators for training-data preparation (text, pages, archives)."""
