"""Structured Streaming: change-topic readers and the raw-log landing."""
