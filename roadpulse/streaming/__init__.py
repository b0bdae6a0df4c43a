"""Jobs that take in new files as they arrive."""
