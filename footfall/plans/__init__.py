"""Whole jobs: read logs, write the reporting tables."""
