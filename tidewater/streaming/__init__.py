"""Structured Streaming forms: word count, top rows per window, interval joins and keyed state."""
