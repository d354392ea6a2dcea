"""The user-level jobs."""
