"""Readers and writers of manifests, stage tables and audio."""
