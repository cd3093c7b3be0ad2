"""Operators composed into jobs."""
