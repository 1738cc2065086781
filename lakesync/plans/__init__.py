"""Whole jobs: publishing, replication, load and repair, record feeds."""
