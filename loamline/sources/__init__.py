"""Readers of file folders, text extraction, and writers."""
