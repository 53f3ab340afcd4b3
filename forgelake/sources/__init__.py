"""Scans: files, message streams and catalog tables."""
