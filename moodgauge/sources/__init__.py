"""Readers, writers and the delta-style post store."""
