"""Stages, queries and their SQL."""
