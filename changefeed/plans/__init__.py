"""Whole jobs: capture, materialize, replay and the read side."""
