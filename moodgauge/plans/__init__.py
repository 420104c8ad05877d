"""Registered queries with their SQL checks."""
