"""Readers, discovery and sinks."""
