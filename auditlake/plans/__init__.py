"""Whole jobs: polls, verification and compaction."""
