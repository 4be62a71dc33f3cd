"""Streaming of the key-phrase engine."""
