"""File-arrival processing with Structured Streaming."""
