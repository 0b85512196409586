"""Column-to-column functions: no action, no shuffle, usable in batch and streaming plans."""
