"""The event feed as Structured Streaming."""
