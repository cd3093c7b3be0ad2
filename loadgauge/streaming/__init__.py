"""Structured Streaming forms of the operators that keep state from one bucket to the next."""
