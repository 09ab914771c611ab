"""Sinks."""
