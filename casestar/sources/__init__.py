"""Readers, writers, raw landing and the published warehouse."""
