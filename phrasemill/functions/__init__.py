"""Functions of the key-phrase engine."""
