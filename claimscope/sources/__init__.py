"""Readers, writers and the relations derived from the base tables."""
