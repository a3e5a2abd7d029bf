"""Scans of raw documents and request-like inputs."""
