"""Readers for landed snapshot files, archive bundles, JSON pages and stored tables."""
