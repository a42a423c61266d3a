"""File landing with Structured Streaming."""
