"""Relational operators over packs, sources, licences and files."""
