"""Readers, writers and parameter tables."""
