"""Scans, test-data mapping, sinks and model persistence."""
