"""Streaming operators."""
