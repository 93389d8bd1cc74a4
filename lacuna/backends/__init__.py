"""Models behind protocols, with deterministic stand-ins."""
