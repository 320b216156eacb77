"""Readers of raw pages and payloads, and the shared scratch area."""
