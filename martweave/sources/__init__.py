"""Readers, writers and catalogue listings."""
