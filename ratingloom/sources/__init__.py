"""Readers, writers and the shared views."""
