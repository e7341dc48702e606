"""Readers, writers, versions and catalog tables."""
