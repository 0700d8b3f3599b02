"""Readers, writers and the staged warehouse."""
