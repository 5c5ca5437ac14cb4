"""Structured Streaming forms of intake and verification."""
