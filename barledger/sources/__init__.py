"""Landed files and documents in, tables and evidence out."""
