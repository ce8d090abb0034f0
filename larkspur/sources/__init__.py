"""Readers and writers of the raw, derived and report layers."""
