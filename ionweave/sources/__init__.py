"""Scans and sinks."""
