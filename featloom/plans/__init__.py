"""Whole jobs: what a user submits."""
