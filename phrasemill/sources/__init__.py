"""Sources of the key-phrase engine."""
