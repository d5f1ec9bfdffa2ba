"""Structured Streaming: stateless scoring of arriving files with the saved
transform and model (scoring)."""
