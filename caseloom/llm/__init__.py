"""Operators for preparing training text: scans, fingerprints, joins, mixing and sharding."""
