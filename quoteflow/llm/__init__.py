"""Operators for preparing training data: dedup, scans, decontamination, sharding, formatting, packing."""
