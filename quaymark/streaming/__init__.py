"""Structured Streaming: the applier and the live snapshot window."""
