"""Epoch tables and the Structured Streaming job that fills them."""
