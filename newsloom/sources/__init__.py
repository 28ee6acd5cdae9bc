"""Readers of landed files and writers of results."""
