"""Incremental and streaming forms of stages."""
