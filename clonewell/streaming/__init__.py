"""Streaming of clonewell."""
