"""Scans, window extracts and sinks."""
