"""Whole jobs, put together from sources, functions, operators and sinks."""
