"""File-stream landing."""
