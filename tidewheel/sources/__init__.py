"""Readers, writers and numbered table snapshots."""
