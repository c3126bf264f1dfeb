"""Readers of payloads and pages."""
