"""Event-time operators on Structured Streaming."""
