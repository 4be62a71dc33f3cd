"""Operators of the key-phrase engine."""
