"""Queue-driven classification with Structured Streaming."""
