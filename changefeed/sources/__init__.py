"""Inputs: source-table scans, the change log and the test feed."""
