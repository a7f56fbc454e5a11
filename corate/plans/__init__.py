"""Composite jobs (C1-C8) and the registered query catalogue."""
