"""Sessions, shared storage and the staged pipeline."""
