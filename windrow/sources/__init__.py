"""Readers and writers for the raw, cleaned, feature and report layers."""
