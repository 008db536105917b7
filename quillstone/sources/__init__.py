"""Readers of specifications, locks and stored files."""
