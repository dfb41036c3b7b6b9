"""Scans: archives, log files, query pages, limits, ledgers and event streams."""
