"""Readers, writers and the event envelope."""
