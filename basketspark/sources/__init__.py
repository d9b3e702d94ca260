"""Scans, sinks and schemas."""
