"""Operators for preparing training text: scans, fingerprints, joins, mixing, sharding, token files."""
