"""Envelopes, idempotent appends and materialisations."""
