"""Scans, catalogs, metadata and diagnostics over sources."""
