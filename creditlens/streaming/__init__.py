"""Structured Streaming form of the application flow."""
