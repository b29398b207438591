"""Operators of clonewell."""
