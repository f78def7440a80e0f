"""Readers, writers and the layers derived from the test tables."""
