"""Operators for preparing training text: scoring, formatting, deduplication, scans, tokens, decontamination."""
