"""Readers, writers and views that feed the operators."""
