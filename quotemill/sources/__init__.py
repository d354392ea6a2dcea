"""Scans. Every parser keeps malformed rows, marked in ``reject_reason``."""
